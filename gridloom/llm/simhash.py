"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits.  Two fingerprints that differ in at most 3 bits differ in at most one
bit of their upper or of their lower half, so each half is searched with threshold one.  The
anchors of a half are the code words of the [31, 26] Hamming code with one free bit appended: a
covering code of radius one with 2^27 words.  A fingerprint's home is the anchor within the
radius; it is replicated to every anchor within radius plus threshold, that is within two: 17 of
them at most.  If two halves differ in one bit at most, the second lies within two of the
first's home, so the pair meets there.  Fingerprints are compared per anchor, all 64 bits, so
the links are exact.

Equal fingerprints are one node before anything is replicated.  An anchor with many fingerprints
is dealt into blocks of bounded size that are compared pair by pair, and a block pair gives a
spanning forest of its links, never all of them; components are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, sorted_join, unused, written
from .components import components

SEED, WORDS, THRESHOLD = 42, 3, 3
#: Fingerprints of one side in a block; fingerprints that a task replicates to their anchors, about.
BLOCK, SPREAD = 1024, 1 << 15


def fingerprint(text: bytes | None, words: int = WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles; no words or null: zero."""
    import numpy as np
    import xxhash

    parts = (text or b"").lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        return xxhash.xxh64_intdigest(b" ".join(parts), seed)
    digest, votes, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(parts) - words + 1
    for at in range(0, n, 1 << 15):
        some = parts[at : at + (1 << 15) + words - 1]
        joined = b" ".join(some)
        sizes = np.fromiter(map(len, some), np.int64, len(some))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(some) - words + 1].tolist()
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        values = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` of every row, ``fp`` the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(_fingerprints, "id long, fp long")


def _syndrome(x: Column) -> Column:
    """Number of the bit (1 to 31) to flip for a Hamming code word; 0: it is one."""
    found = F.lit(0).cast("long")
    for j in range(5):
        mask = sum(1 << (i - 1) for i in range(1, 32) if i >> j & 1)
        found = found.bitwiseOR(F.shiftleft(F.bit_count(x.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1)).cast("long"), j))
    return found


def _flip(i: Column) -> Column:
    """The bit numbered ``i``, counted from 1; 0: none."""
    return F.when(i > 0, F.call_function("shiftleft", F.lit(1).cast("long"), (i - 1).cast("int"))).otherwise(F.lit(0).cast("long"))


def _anchors(half: Column, number: int) -> tuple[Column, Column]:
    """The anchors within two of a 32-bit half, and the home among them; ``number`` tells the halves apart."""
    free, tag = F.lit(1 << 31), F.lit(number << 32)
    s = _syndrome(half.bitwiseAND(F.lit((1 << 31) - 1)))
    home = half.bitwiseXOR(_flip(s))
    pairs = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: half.bitwiseXOR(_flip(i.cast("long"))).bitwiseXOR(_flip(i.cast("long").bitwiseXOR(s))))
    near = F.array_distinct(F.concat(pairs, F.array(home.bitwiseXOR(free))))
    return F.transform(near, lambda a: a.bitwiseOR(tag)), home.bitwiseOR(tag)


def _home(half: Column, number: int) -> Column:
    """The home alone."""
    return half.bitwiseXOR(_flip(_syndrome(half.bitwiseAND(F.lit((1 << 31) - 1))))).bitwiseOR(F.lit(number << 32))


def _forest(batches: Iterator) -> Iterator:
    """Spanning forests of the links between the homes and the visitors of each block pair."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        a, b = [], []
        homes, visits = batch.column(0), batch.column(1)
        hv, ho = homes.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(homes.value_lengths().to_numpy())])
        vv, vo = visits.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(visits.value_lengths().to_numpy())])
        for k in range(batch.num_rows):
            h, v = hv[ho[k] : ho[k + 1]], vv[vo[k] : vo[k + 1]]
            linked = np.bitwise_count((h[:, None] ^ v[None, :]).view(np.uint64)) <= THRESHOLD
            linked &= h[:, None] != v[None, :]
            if not linked.any():
                continue
            left = linked.any(1)
            while left.any():
                at = int(left.argmax())
                wave, seen = np.zeros(len(h), bool), np.zeros(len(v), bool)
                wave[at], left[at], root = True, False, h[at]
                while wave.any():
                    new = linked[wave].any(0) & ~seen
                    seen |= new
                    wave = left & linked[:, new].any(1)
                    left &= ~wave
                    found = np.concatenate([v[new], h[wave]])
                    found = found[found != root]
                    a.append(np.full(len(found), root))
                    b.append(found)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def _places(nodes: DataFrame) -> DataFrame:
    """``(cell, fp, home)``: every fingerprint at each of its 34 anchors at most."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    sides = [_anchors(low, 0), _anchors(high, 1)]
    found = nodes.select("fp", F.explode(F.concat(*(a for a, _ in sides))).alias("cell"), *(h.alias(f"home{k}") for k, (_, h) in enumerate(sides)))
    return found.select("cell", "fp", ((F.col("cell") == F.col("home0")) | (F.col("cell") == F.col("home1"))).alias("home"))


def links(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` that join what differs in 3 bits or fewer, of distinct fingerprints ``fp``.

    ``nodes`` is a table that is cheap to read.  Its rows are spread over tasks by their number before they are replicated, and
    replicas are written once, only those that meet another fingerprint at home with their anchor.
    No side of a join is broadcast: Spark takes 34 replicas for one row when it estimates their size.
    """
    spread = nodes.select("fp").repartition(max(1, -(-nodes.count() // SPREAD)), "fp")
    half = [F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)]
    owners = nodes.select("fp", F.explode(F.array(*(_home(h, k) for k, h in enumerate(half)))).alias("cell"))
    homes = written(owners.groupBy("cell").agg(F.count("*").alias("n_home"), F.min("fp").alias("only")), "simhash-homes")
    lonely = (F.col("n_home") == 1) & (F.col("only") == F.col("fp"))
    meet = written(_places(spread).join(sorted_join(homes), "cell").where(~lonely).select("cell", "fp", F.ceil(F.col("n_home") / block).alias("hs")), "simhash-visits")
    size = written(meet.groupBy("cell").agg(F.max("hs").alias("hs"), F.ceil(F.count("*") / block).alias("vs")), "simhash-cells")
    salt = F.xxhash64("fp")
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    dealt = meet.join(sorted_join(size.select("cell", "vs")), "cell").select("cell", "fp", F.lit(False).alias("home"), upto("hs").alias("hb"), F.pmod(salt, "vs").alias("vb"))
    asked = owners.join(sorted_join(size), "cell").select("cell", "fp", F.lit(True).alias("home"), F.pmod(salt, "hs").alias("hb"), upto("vs").alias("vb"))
    pairs = asked.unionByName(dealt).groupBy("cell", "hb", "vb").agg(F.collect_list(F.when(F.col("home"), F.col("fp"))).alias("h"), F.collect_list(F.when(~F.col("home"), F.col("fp"))).alias("v"))
    found = written(pairs.where("size(h) > 0 AND size(v) > 0").select("h", "v").mapInArrow(_forest, "a long, b long"), "simhash-links")
    forget(homes, meet, size)
    return found


def _grouped(prints: DataFrame, block: int) -> DataFrame:
    """A written table ``(fp, root, component_id)`` of the distinct fingerprints of ``prints`` (id, fp)."""
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("id")), "simhash-nodes")
    linked = links(nodes, block)
    roots = components(linked)
    of = written(nodes.join(sorted_join(roots), nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "id"), "simhash-roots")
    # A table of its own: a join with the aggregate of its own rows could not be split where one component holds most of them.
    least = written(of.groupBy("root").agg(F.min("id").alias("component_id")), "simhash-least")
    found = written(of.join(sorted_join(least), "root").select("fp", "root", "component_id"), "simhash-components")
    forget(nodes, linked, of, least)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document: ``(doc_id, fingerprint, component_id)``.

    Texts are lower-cased (A-Z only) and split at ASCII white space; the shingles have three words,
    repeats count.  A null or empty text has fingerprint zero and is linked like any other.  Rows
    that repeat an id keep a row each.  A null id is kept, and never is a ``component_id`` unless no
    document of the component has an id.  Other columns of ``docs`` are ignored, whatever their
    names.  No rows: an empty result.
    """
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    return prints.join(sorted_join(_grouped(prints, block)), "fp").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The documents with one of each near-duplicate group left: the one with the smallest id.

    All columns stay as they are, whatever their names.  Documents in different groups all stay,
    even if they share an id; of rows of one group that share the smallest id, one of those with
    the smallest fingerprint stays.  Rows without an id have nothing that tells them apart and all
    stay.

    Documents are joined to the chosen ids alone.  Only of ids that several rows share are whole
    documents fingerprinted again and ranked.
    """
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    of = prints.where("id IS NOT NULL").join(sorted_join(_grouped(prints, block)), "fp").where("id = component_id")
    best = written(of.groupBy("root", "id").agg(F.min("fp").alias("fp")), "simhash-best")
    often = prints.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1")
    chosen = best.join(often, "id", "left_anti").select("id")
    key = unused(docs, "kept_id")
    only = docs.join(chosen.withColumnRenamed("id", key), F.col(id_col).cast("long") == F.col(key), "left_semi")
    return only.unionByName(_once(docs, best.join(often, "id", "left_semi"), id_col, text_col)).unionByName(docs.where(F.col(id_col).isNull()))


def _once(docs: DataFrame, best: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of the rows of ``docs`` whose id repeats, one for each ``(id, fp)`` of ``best``."""
    from pyspark.sql import Window
    from pyspark.sql.types import LongType, StructField, StructType

    key, mark, turn = unused(docs, "kept_id"), unused(docs, "print"), unused(docs, "turn")
    names = docs.columns
    some = docs.join(best.select(F.col("id").alias(key)).distinct(), F.col(id_col).cast("long") == F.col(key), "left_semi")
    at, schema = names.index(text_col), StructType([*docs.schema.fields, StructField(mark, LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            values = [fingerprint(t.as_py().encode() if isinstance(t.as_py(), str) else t.as_py()) for t in batch.column(at)]
            signed = [v - (1 << 64) if v >> 63 else v for v in values]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signed, pa.int64())], [*batch.schema.names, mark])

    marked = some.mapInArrow(run, schema)
    fits = marked.join(best.select(F.col("id").alias(key), F.col("fp").alias(turn)), (F.col(id_col).cast("long") == F.col(key)) & (F.col(mark) == F.col(turn)), "left_semi")
    order = Window.partitionBy(id_col, mark).orderBy(*[F.col(f"`{c}`") for c in names if c == text_col])
    return fits.withColumn(turn, F.row_number().over(order)).where(F.col(turn) == 1).select(*names)
