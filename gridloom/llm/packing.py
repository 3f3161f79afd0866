"""Packing documents into sequences by cutting-stock column generation.

A document's ids are cut into whole sequences and one rest.  Rests are sorted into classes of a
few tokens; the histogram of the classes, a fixed number of counts however many documents there
are, is all that the driver sees.  A linear program chooses how often to use each pattern (a
multiset of classes that fits a sequence); its columns are generated by a knapsack dynamic
program over the duals.  The solution is rounded down, and what is left over, fewer pieces than
the basis has classes times a pattern's pieces, is packed first-fit decreasing.

Pieces are ranked within their class without a global sort: a task numbers its own, and the
counts of the tasks are added up.  A rank then falls into the range of slots that one pattern has
for the class, which gives the sequence and the slot.
"""

from __future__ import annotations

import logging
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

LENGTH, QUANTUM = 2048, 8
#: Columns generated at most; the program is feasible at every step, so stopping costs padding only.
COLUMNS = 4000
#: Pieces, and bytes of their ids, in an Arrow batch at most, about.
ROWS, BYTES = 1024, 1 << 23

_log = logging.getLogger(__name__)

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, class int, part int, local long"


def knapsack(values, capacity: int) -> tuple[float, list[int]]:
    """Largest total value of items, item k weighing k + 1 and used any number of times, and how often each is used."""
    import numpy as np

    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        total = values[:c] + best[c - 1 :: -1][: min(c, len(values))]
        at = int(total.argmax())
        best[c], pick[c] = (total[at], at + 1) if total[at] > best[c - 1] else (best[c - 1], 0)
    counts, c = [0] * len(values), capacity
    while c:
        if pick[c]:
            counts[pick[c] - 1] += 1
        c -= max(1, int(pick[c]))
    return float(best[capacity]), counts


def patterns(histogram: dict[int, int], capacity: int, columns: int = COLUMNS) -> list[tuple[int, dict[int, int]]]:
    """How often to use each pattern ``{class: pieces}``, so that all pieces of ``histogram`` have a slot.

    A class k fills k units of ``capacity``.  Every piece has exactly one slot and no pattern
    overflows.
    """
    import numpy as np

    classes = sorted(k for k, n in histogram.items() if n)
    if not classes:
        return []
    m, need = len(classes), np.array([histogram[k] for k in classes], float)
    fit = np.array([capacity // k for k in classes], float)
    basis, inverse, used = np.diag(fit), np.diag(1 / fit), need / fit
    place = {k: i for i, k in enumerate(classes)}
    for _ in range(columns):
        duals = inverse.sum(0)
        values = np.full(capacity, -1.0)
        values[[k - 1 for k in classes]] = duals
        value, counts = knapsack(values, capacity)
        if value <= 1 + 1e-7:
            break
        column = np.zeros(m)
        for k, n in enumerate(counts, 1):
            if n:
                column[place[k]] = n
        step = inverse @ column
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        used = np.maximum(used - ratio[out] * step, 0)
        used[out] = ratio[out]
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        basis[:, out] = column
    else:
        _log.warning("packing stopped after %d columns; the padding may not be the least", columns)
    left = dict(zip(classes, (histogram[k] for k in classes), strict=True))
    chosen: list[tuple[int, dict[int, int]]] = []
    for j in range(m):
        shape = {classes[i]: int(basis[i, j]) for i in range(m) if basis[i, j]}
        times = min(int(used[j] + 1e-6), *(left[k] // n for k, n in shape.items())) if len(shape) else 0
        if times > 0:
            chosen.append((times, shape))
            for k, n in shape.items():
                left[k] -= times * n
    while any(left.values()):
        shape, room = {}, capacity
        for k in reversed(classes):
            if n := min(left[k], room // k):
                shape[k], room = n, room - n * k
        times = max(1, min(left[k] // n for k, n in shape.items()))
        chosen.append((times, shape))
        for k, n in shape.items():
            left[k] -= times * n
    return chosen


def _cut(tokenizer: str, end_id: int, length: int, quantum: int, room: int | None):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        from .wordcodec import encoder, id_bytes

        encode, end, part, seen = encoder(tokenizer, room), id_bytes([end_id]), TaskContext.get().partitionId(), {}
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64())
        flush = lambda rows: pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])
        for batch in batches:
            rows, held = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, length):
                    piece = ids[4 * start : 4 * (start + length)]
                    size = len(piece) // 4
                    kind = -(-size // quantum)
                    rank = seen[kind] = seen.get(kind, -1) + 1
                    rows.append((doc, start, size, zlib.crc32(piece), total, piece, kind, part, rank))
                    held += len(piece)
                    if held > BYTES or len(rows) == ROWS:
                        yield flush(rows)
                        rows, held = [], 0
            if rows:
                yield flush(rows)

    return run


def cut(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, quantum: int = QUANTUM, id_col: str = "doc_id", text_col: str = "text", room: int | None = None) -> DataFrame:
    """The pieces of all documents with their ids, as a written table; ``room`` bytes of met words in each worker."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return written(rows.mapInArrow(_cut(tokenizer, end_id, length, quantum, room), PIECES), "pieces", "zstd")


def _place(slots):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table = slots.value
        for batch in batches:
            kinds = batch.column(batch.schema.get_field_index("class")).to_numpy()
            ranks = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            sequence, slot = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
            for kind in np.unique(kinds):
                here = kinds == kind
                first, base, each, before = table[int(kind)]
                at = np.searchsorted(first, ranks[here], "right") - 1
                nth, k = np.divmod(ranks[here] - first[at], each[at])
                sequence[here], slot[here] = base[at] + nth, before[at] + k
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(5)] + [pa.array(sequence), pa.array(slot)], batch.schema.names[:5] + ["sequence_id", "slot"])

    return run


def place(pieces: DataFrame, length: int = LENGTH, quantum: int = QUANTUM) -> DataFrame:
    """Sequence and offset of every piece of a table made by :func:`cut`."""
    import numpy as np

    counts = pieces.groupBy("class", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    shifts = written(counts.select("class", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")), "ranks")
    histogram = {r["class"]: r["n"] for r in shifts.groupBy("class").agg(F.sum("n").alias("n")).collect()}  # length / quantum rows at most
    table: dict[int, list] = {}
    next_rank, sequence = dict.fromkeys(histogram, 0), 0
    for times, shape in patterns(histogram, length // quantum):
        slot = 0
        for kind in sorted(shape, reverse=True):
            table.setdefault(kind, []).append((next_rank[kind], sequence, shape[kind], slot))
            next_rank[kind] += times * shape[kind]
            slot += shape[kind]
        sequence += times
    slots = pieces.sparkSession.sparkContext.broadcast({k: np.array(v, np.int64).T for k, v in table.items()})
    ranked = pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "part", "local").join(shifts.drop("n"), ["class", "part"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", (F.col("local") + F.col("shift")).alias("rank"))
    placed = ranked.mapInArrow(_place(slots), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long")
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, quantum: int = QUANTUM, room: int | None = None) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of every piece.

    A null or empty text is the end id alone.  Rows that repeat an id, and rows without one, are
    documents of their own.  Other columns are ignored.  No rows: an empty result.
    """
    return place(cut(docs, tokenizer, end_id, length, quantum, room=room), length, quantum)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """``(sequence_id, ids binary)``: the sequences' ids, little-endian and 32 bits wide, before padding.

    ``pieces`` and ``placed`` come from :func:`cut` and :func:`place`; document ids must be unique.
    """
    both = placed.select("doc_id", "start", "sequence_id", "offset").join(pieces.select("doc_id", "start", "ids"), ["doc_id", "start"])
    parts = both.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))
