"""Token ids as binary shards: frequency ranks in byte-aligned variable-length codes.

A first pass encodes every text.  Ids are then ranked by how often they occur in all texts, so
frequent ids get small numbers.  A rank takes one to four data bytes; its size less one is put in
two bits of a separate stream of control bytes, four ranks to the byte.  Frequent ids so cost ten
bits, and a decoder finds the places of four values with one look into a table of 256 rows.

The files are two tables in the shared folder, written by Spark's committers, so that a lost
executor or a task run twice leaves no torn file:

``ranks``   ``rank int, id long``: the id of each rank, most frequent first, ties to smaller ids.
``blocks``  ``shard int, block int, at long, doc_ids array<long>, lens array<int>, n_ids long,
            controls binary, data binary``: documents in ascending id order, shard after shard and
            block after block; ``at`` counts the ids of the shard before the block, ``lens`` the
            ids of each document, its end id included.  The streams of a block hold the ranks of
            all of them, one after another.

Documents are dealt to shards by ranges of their id, so shards are written and read in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, new_path, written

#: Ids of a shard and of a block, about; a document is never cut, so a block holds one at least.
SHARD_IDS, BLOCK_IDS = 16_000_000, 400_000


def pack(ranks) -> tuple[bytes, bytes]:
    """Control and data bytes of an array of ranks below 2^32."""
    import numpy as np

    ranks = np.asarray(ranks, "<u4")
    sizes = 1 + (ranks > 0xFF) + (ranks > 0xFFFF).astype(np.int8) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = sizes - 1
    controls = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    keep = np.arange(4) < sizes[:, None]
    return controls.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def unpack(controls: bytes, data: bytes, count: int):
    """The ``count`` ranks that :func:`pack` coded."""
    import numpy as np

    look = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)
    sizes = look[np.frombuffer(controls, np.uint8)].reshape(-1)[:count]
    out = np.zeros((count, 4), np.uint8)
    out[np.arange(4) < sizes[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


#: Texts encoded between two Arrow batches: so many, or fewer once they have so many ids.
ROWS, IDS = 1024, 1 << 21

ENCODED = "doc_id long, width byte, ids binary, counts binary"


def _encode(tokenizer: str, end_id: int):
    """Rows ``ENCODED``: the ids of each document in 16 or 32 bits, and one row for a task's counts of every id.

    A batch holds ``IDS`` ids and one document's at most, so only a single document of over 500
    million ids is too long for it.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from .wordcodec import encoder, id_bytes

        encode, end, total = encoder(tokenizer), id_bytes([end_id]), np.zeros(0, np.int64)

        def encoded(docs: list, found: list):
            nonlocal total
            wide = np.frombuffer(b"".join(found), "<u4")
            counts = np.bincount(wide)
            if len(counts) > len(total):
                total = np.pad(total, (0, len(counts) - len(total)))
            total[: len(counts)] += counts
            size = 2 if len(counts) <= 1 << 16 else 4
            ends = np.cumsum([0, *map(len, found)]) // 4 * size
            ids = pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(wide.astype(f"<u{size}"))])
            return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(np.full(len(docs), size, np.int8)), ids, pa.nulls(len(docs), pa.binary())], NAMES)

        for batch in batches:
            docs, found, held = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                if docs and (len(docs) == ROWS or held + len(ids) > 4 * IDS):
                    yield encoded(docs, found)
                    docs, found, held = [], [], 0
                docs.append(doc)
                found.append(ids)
                held += len(ids)
            if docs:
                yield encoded(docs, found)
        if len(total):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int8()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())], NAMES)

    return run


NAMES = [x.split()[0] for x in ENCODED.split(", ")]


def _count(batches: Iterator) -> Iterator:
    """How often each id occurs, from the counts of several tasks: no more rows than the vocabulary has."""
    import numpy as np
    import pyarrow as pa

    total = np.zeros(0, np.int64)
    for batch in batches:
        for kept in batch.column(0):
            found = np.frombuffer(kept.as_py(), "<i8")
            if len(found) > len(total):
                total = np.pad(total, (0, len(found) - len(total)))
            total[: len(found)] += found
    ids = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])


def _blocks(rank_of, block_ids: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        shard, number, before, docs, lens, parts, held = TaskContext.get().partitionId(), 0, 0, [], [], [], 0

        def block():
            controls, data = pack(rank_of.value[np.concatenate(parts)])
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "block": pa.array([number], pa.int32()), "at": pa.array([before], pa.int64()), "doc_ids": pa.array([docs], pa.list_(pa.int64())), "lens": pa.array([lens], pa.list_(pa.int32())), "n_ids": pa.array([held], pa.int64()), "controls": pa.array([controls], pa.binary()), "data": pa.array([data], pa.binary())}
            )

        for batch in batches:
            for doc, width, kept in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids = np.frombuffer(kept.as_py(), f"<u{width}")
                if docs and held + len(ids) > block_ids:
                    yield block()
                    number, before, docs, lens, parts, held = number + 1, before + held, [], [], [], 0
                docs.append(doc)
                lens.append(len(ids))
                parts.append(ids)
                held += len(ids)
        if docs:
            yield block()

    return run


BLOCKS = "shard int, block int, at long, doc_ids array<long>, lens array<int>, n_ids long, controls binary, data binary"


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS, block_ids: int = BLOCK_IDS) -> None:
    """Write the tables ``ranks`` and ``blocks`` of ``docs`` under ``path``.

    A null or empty text is the end id alone.  Rows that repeat an id follow each other, those
    without one come first.  Other columns are ignored.  No rows: both tables are empty.
    """
    import numpy as np

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    kept = written(rows.mapInArrow(_encode(tokenizer, end_id), ENCODED), "ids", "zstd")
    counts = kept.where("counts IS NOT NULL").select("counts").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One row for each id of the vocabulary: its size bounds what the driver sorts and sends out.
    ranked = [(r["id"], r["n"]) for r in counts.collect()]
    ranked.sort(key=lambda r: (-r[1], r[0]))
    spark.createDataFrame([(k, i) for k, (i, _) in enumerate(ranked)], "rank int, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(1 + max((i for i, _ in ranked), default=0), np.uint32)
    rank_of[[i for i, _ in ranked]] = np.arange(len(ranked))
    shards = 1 + sum(n for _, n in ranked) // shard_ids
    ids = kept.where("width IS NOT NULL").select("doc_id", "width", "ids")
    dealt = ids.repartitionByRange(max(shards, 2), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    sent = spark.sparkContext.broadcast(rank_of)
    dealt.mapInArrow(_blocks(sent, block_ids), BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    forget(kept)


def _decode(ids_of):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, lens, start, n, controls, data = (batch.column(k)[row].as_py() for k in range(6))
                lens = np.asarray(lens, np.int64)
                ids = ids_of.value[unpack(controls, data, n)].astype("<u4")
                ends = np.cumsum(lens)
                view = memoryview(ids).cast("B")
                crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((ends - lens).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(start + ends - lens), "n_tokens": pa.array(lens), "ids_crc32": pa.array(crcs, pa.int64())})

    return run


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files under ``path``."""
    import numpy as np

    ranks = spark.read.schema("rank int, id long").parquet(f"{path}/ranks").collect()  # a row for each id of the vocabulary
    ids_of = np.zeros(max(1, len(ranks)), np.uint32)
    for r in ranks:
        ids_of[r["rank"]] = r["id"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    shards = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    # One row for each shard is joined; the blocks are not dealt anew while those rows are few.
    rows = blocks.join(shards, "shard").select("doc_ids", "lens", (F.col("shard_start") + F.col("at")).alias("start"), "n_ids", "controls", "data")
    return rows.mapInArrow(_decode(spark.sparkContext.broadcast(ids_of)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` into a new folder of the shared folder and read the files back."""
    path = new_path(docs.sparkSession, "token-ids")
    write(docs, path, tokenizer, end_id)
    return read_digests(docs.sparkSession, path)
