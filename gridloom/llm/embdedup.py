"""Embedding near-duplicates: an exact metric range join.

Vectors are scaled to length one, where the angle is a metric and cosine c is the angle arccos(c).
Pivots drawn from the data partition the sphere: a vector's home is the cell of its nearest pivot.
If x is at home with p and y within the angle t of x, the triangle inequality bounds how far y can
lie beyond the border between p and its own pivot q: the sine of that angle is
``y . (q - p) / |q - p|``, and must be at most ``sin t``.  A second bound,
``angle(y, p) <= angle(x, p) + t``, spares close copies.

The vectors of a cell are written once, as blocks of bounded size that carry the bounds of their rows.
Two blocks are compared unless a bound excludes all of their pairs.  Blocks meet in a product of
that table with itself, whose tasks read it in place: no vector is replicated or shuffled again, so the disk that is
needed grows with the rows.  A block pair gives each vector's number of links and a
spanning forest, never the pairs.  Products in single precision leave out what is safely below the
cosine, the rest is decided in double precision.  In 64 directions that are spread evenly, few
pairs of blocks can be told apart by any such bound; then nearly all pairs are compared, by matrix
products, and that time grows with the square of the rows.

Equal vectors stand side by side in a block and are one class there.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, sorted_join, written
from .components import components
from .vectors import matrix, usable

COSINE = 0.95
#: Vectors at home with a pivot, about; pivots at most; vectors of a block, and bytes of one, at most.
CELL, PIVOTS, BLOCK, BLOCK_BYTES = 4096, 512, 4096, 2 << 20
#: Blocks that a task writes, about, which are read together; tasks at least.
TOGETHER, TASKS = 8, 12
#: Slack for rounding when blocks are chosen; the links themselves are decided by the cosine alone.
SLACK = 1e-6


def _units(v):
    import numpy as np

    v = v / np.abs(v).max(1, keepdims=True)  # no overflow of very large, no underflow of very small components
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _homes(pivots, kind: str):
    """Rows ``(id, v)`` with their cell and their cosine there in hundredths, the vector as bytes of numbers of ``kind``."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        p = pivots.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                v = matrix(part.column(1)) + 0.0  # no negative zeros: equal vectors have equal bytes
                cos = np.round(_units(v) @ p.T, 9)  # the same for equal vectors, whatever rows they are among
                home = cos.argmax(1)
                raw = pa.array([x.tobytes() for x in v.astype(kind)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), raw, pa.array(home.astype(np.int32)), pa.array((cos[np.arange(len(home)), home] * 100).astype(np.int32))], ["id", "raw", "cell", "near"])

    return run


_BLOCK = "block long, turn int, cell int, radius double, reach array<double>, cls binary, sizes binary, raw binary, ids array<long>, of array<long>, size array<long>"


def _blocks(pivots, kind: str, block: int, angle: float):
    """Blocks of sorted rows ``(id, raw, cell)``; ``reach`` has for each pivot the least angle of a row to it, if a row may link into its cell."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        p, task, turn = pivots.value, TaskContext.get().partitionId(), 0
        gap = np.sqrt(np.maximum(2 - 2 * p @ p.T, 1e-30))
        cell, cls, raws, ids, owner = None, [], [], [], []

        def made():
            cos = _units(np.frombuffer(b"".join(raws), kind).reshape(len(raws), -1).astype(np.float64)) @ p.T
            own = cos[:, cell]
            near = (own[:, None] - cos).min(0) <= math.sin(angle) * gap[cell] + SLACK
            reach = np.where(near, np.arccos(np.clip(cos.max(0), -1, 1)), 10.0)
            reach[cell] = np.arccos(np.clip(own.max(), -1, 1))
            at = np.array(owner)
            sizes, first = np.bincount(at, minlength=len(raws)), np.array(cls, np.int64)
            row = [task << 20 | turn, task + turn, cell, float(np.arccos(np.clip(own.min(), -1, 1))), reach, first.tobytes(), sizes.astype(np.int64).tobytes(), b"".join(raws), np.array(ids, np.int64), first[at], sizes[at]]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()), *[pa.binary()] * 3, *[pa.list_(pa.int64())] * 3]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], [c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            for i, raw, c in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if raws and c == cell and raw == raws[-1]:
                    if i != ids[-1]:
                        ids.append(i)
                        owner.append(len(raws) - 1)
                    continue
                if raws and (c != cell or len(raws) == block):
                    yield made()
                    turn, cls, raws, ids, owner = turn + 1, [], [], [], []
                owner.append(len(raws))
                cell = c
                cls.append(i)
                raws.append(raw)
                ids.append(i)
        if raws:
            yield made()

    return run


def _forest(linked, rows, cols) -> tuple[list, list]:
    """A spanning forest of the links between ``rows`` and ``cols``."""
    import numpy as np

    a, b, left = [], [], linked.any(1)
    while left.any():
        at = int(left.argmax())
        wave, seen = np.zeros(len(rows), bool), np.zeros(len(cols), bool)
        wave[at], left[at], root = True, False, rows[at]
        while wave.any():
            new = linked[wave].any(0) & ~seen
            seen |= new
            wave = left & linked[:, new].any(1)
            left &= ~wave
            found = np.concatenate([cols[new], rows[wave]])
            found = found[found != root]
            a.append(np.full(len(found), root))
            b.append(found)
    return a, b


def _compare(threshold: float, kind: str, dim: int):
    """For block pairs ``(block, cls, sizes, raw)`` twice: links ``(a, b)`` of a spanning forest, and numbers of links of ``a`` where ``b`` is null."""
    import collections

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, links = collections.OrderedDict(), {}
        safe = threshold - 2e-7 * (dim + 8)

        def block(row, at):
            name = row[at].as_py()
            if name not in held:
                u = _units(np.frombuffer(row[at + 3].as_buffer(), kind).reshape(-1, dim).astype(np.float64))
                held[name] = np.frombuffer(row[at + 1].as_py(), np.int64), np.frombuffer(row[at + 2].as_py(), np.int64).astype(np.float64), u, u.astype(np.float32)
            held.move_to_end(name)
            while len(held) > 2 + TOGETHER:
                held.popitem(last=False)
            return name, *held[name]

        def counted():
            for cls, n in links.values():
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(cls[some]), pa.nulls(len(some), pa.int64()), pa.array(n[some].astype(np.int64))], ["a", "b", "links"])
            links.clear()

        for batch in batches:
            for k in range(batch.num_rows):
                row = [c[k] for c in batch.columns]
                (one, ac, an, au, af), (two, bc, bn, bu, bf) = block(row, 0), block(row, 4)
                close = af @ bf.T
                rows = np.flatnonzero(close.max(1) >= safe)
                if not len(rows):
                    continue
                cols = np.flatnonzero(close[rows].max(0) >= safe)
                if one == two:
                    rows = cols = np.union1d(rows, cols)
                linked = au[rows] @ bu[cols].T >= threshold
                linked &= ac[rows, None] != bc[None, cols]
                if one == two:
                    linked |= linked.T
                if not linked.any():
                    continue
                n = linked.astype(np.float64)
                links.setdefault(one, (ac, np.zeros(len(ac))))[1][rows] += n @ bn[cols]
                if one != two:
                    links.setdefault(two, (bc, np.zeros(len(bc))))[1][cols] += an[rows] @ n
                a, b = map(np.concatenate, _forest(linked, ac[rows], bc[cols]))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "links"])
                if len(links) > 256:
                    yield from counted()
        yield from counted()

    return run


def _found(vectors: DataFrame, cosine: float, dim: int, kind: str, cell: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Written tables of what :func:`_compare` gives for ``vectors`` (id, v) of ``dim`` components, and of the blocks."""
    import numpy as np

    spark, n, angle = vectors.sparkSession, vectors.count(), math.acos(cosine)
    block = max(1, min(block, BLOCK_BYTES // (8 * dim)))
    # At most PIVOTS vectors, drawn by a hash of their id.
    drawn = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(max(1, min(PIVOTS, n // cell))).select("v").collect()
    pivots = spark.sparkContext.broadcast(np.unique(_units(np.array([r["v"] for r in drawn])), axis=0))
    rows = vectors.mapInArrow(_homes(pivots, kind), "id long, raw binary, cell int, near int").withColumn("h", F.xxhash64("raw"))
    # The id is a part of the range, so a vector that is very common falls to many tasks.
    dealt = rows.repartitionByRange(max(TASKS, -(-n // (TOGETHER * block))), "cell", "near", "h", "id").sortWithinPartitions("cell", "near", "h", "raw", "id")
    blocks = written(dealt.select("id", "raw", "cell").mapInArrow(_blocks(pivots, kind, block, angle), _BLOCK), "vector-blocks")
    names = ["block", "cls", "sizes", "raw", "turn", "cell", "radius", "reach"]
    a, b = (blocks.select(*(F.col(c).alias(x + c) for c in names)) for x in "ab")
    into = lambda x, y: F.get(F.col(f"{x}reach"), F.col(f"{y}cell")) <= F.col(f"{y}radius") + F.lit(angle + SLACK)
    # Of (a, b) and (b, a) one, so that each task has about half of its pairs.
    once = (F.col("ablock") == F.col("bblock")) | ((F.col("ablock") < F.col("bblock")) == ((F.col("aturn") + F.col("bturn")) % 2 == 0))
    pairs = a.join(b.hint("shuffle_replicate_nl"), once & into("a", "b") & into("b", "a"))
    found = written(pairs.select(*(x + c for x in "ab" for c in names[:4])).mapInArrow(_compare(cosine, kind, dim), "a long, b long, links long"), "vector-links")
    return found, blocks


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
    neither do rows without an id.  Vectors link only with vectors of their own length (number of
    components); each length is joined on its own.  Rows that repeat an id count as one vector if the vectors are
    equal.  Other columns are ignored.  No rows: no rows.
    """
    fine = usable(vectors, id_col, vector_col)
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    lengths = sorted(r["dim"] for r in fine.select(F.size("v").alias("dim")).distinct().collect())  # a row for each length
    if not lengths:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    kind = "<f4" if dict(vectors.dtypes)[vector_col] == "array<float>" else "<f8"
    joined = [_found(fine.where(F.size("v") == d), cosine, d, kind, cell, block) for d in lengths]
    found = functools.reduce(DataFrame.unionByName, (links for links, _ in joined))
    # Tables of their own, so that the rows of one vector can be split where they are joined to it.
    members = written(functools.reduce(DataFrame.unionByName, (b.select(F.inline(F.arrays_zip("ids", "of", "size"))) for _, b in joined)).toDF("id", "cls", "members"), "vector-members")
    counts = written(found.where("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links")), "vector-counts")
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "cls")
    known = written(counts.join(sorted_join(roots), "cls"), "vector-classes")
    forget(counts, *(t for pair in joined for t in pair))
    of = members.join(sorted_join(known), "cls", "left").groupBy("id").agg(F.max(F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.min(F.coalesce("root", "cls")).alias("component_id"))
    out = every.join(sorted_join(of), every["vec_id"] == of["id"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
