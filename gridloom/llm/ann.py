"""Approximate nearest neighbours: a robust-pruned directed graph for each shard.

Equal vectors are one point, named by the smallest of their ids and a hash of the vector.  Points
are dealt to shards of bounded size by a hash of that id; a shard is a binary table row of its
vectors and its graph, so it is built, lost and rebuilt by one task.  A shard holds vectors of one
length (number of components) and of norms within a factor of ``2 ** BAND``, so that single
precision serves for the walks whatever the norms are; scores are taken in double.

Largest inner product is made nearest by distance: one more component brings all vectors of a
shard to the norm of its longest, queries have zero there.

A graph starts with random edges.  Its points are inserted in batches: a greedy search from the
middle point walks the graph and proposes the points it met as neighbours; relaxed distance
pruning then takes the nearest candidate and drops all that are ``ALPHA`` times nearer to it than
to the point, and so on, which keeps short edges and those that lead elsewhere.  Chosen edges are
made known to their ends, which prune again when they have too many.

Queries are sent to every shard and beam-searched there in blocks.  A query's best points of all
shards are replaced by the rows that have these vectors, as many of each as a result can hold, so
a vector that a third of all rows share costs one point and its ties are in exact order.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, written
from .vectors import matrix, usable

K = 20
#: Vectors of a shard, about; out-edges of a point; beams of the build and of the search.
SHARD, DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 8192, 32, 48, 80, 1.15
#: Powers of two that the norms of a shard span.
BAND = 4
#: Points or queries that walk the graph at once.
BATCH = 256


def beam_search(points, graph, start: int, queries, beam: int, candidates: int):
    """Places and scores (largest first) of what the walks of ``queries`` met, ``candidates`` each, and how many points each met.

    All points have one length, so the largest inner product is the nearest.  Unfilled places are
    -1 with score -inf.
    """
    import numpy as np

    n, m = len(points), len(queries)
    seen = np.zeros((m, n + 1), bool)
    seen[:, [start, n]] = True
    place = np.full((m, candidates), -1, np.int64)
    score = np.full((m, candidates), -np.inf, np.float32)
    done = np.ones((m, candidates), bool)
    place[:, 0], score[:, 0], done[:, 0] = start, queries @ points[start], False
    live = np.arange(m)
    while len(live):
        todo = ~done[live, :beam]
        has = todo.any(1)
        live, todo = live[has], todo[has]
        if not len(live):
            break
        at = todo.argmax(1)
        done[live, at] = True
        near = graph[place[live, at]]
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        row, col = np.nonzero(fresh)
        got = np.full(near.shape, -np.inf, np.float32)
        got[row, col] = np.einsum("rd,rd->r", points[near[row, col]], queries[live[row]])
        all_score = np.concatenate([score[live], got], 1)
        order = np.argsort(-all_score, 1, kind="stable")[:, :candidates]
        rows = np.arange(len(live))[:, None]
        score[live] = all_score[rows, order]
        place[live] = np.concatenate([place[live], np.where(fresh, near, -1)], 1)[rows, order]
        done[live] = np.concatenate([done[live], ~fresh], 1)[rows, order]
    place[np.isneginf(score)] = -1
    return place, score, seen[:, :n].sum(1)


def prune(points, who, candidates, degree: int, alpha: float):
    """Out-edges of the points ``who`` chosen from ``candidates`` (-1: none), n where unfilled."""
    import numpy as np

    n = len(points)
    candidates = np.where(candidates == who[:, None], -1, candidates)
    candidates = np.sort(candidates, 1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    x = points[np.maximum(candidates, 0)]
    far = ((x - points[who][:, None]) ** 2).sum(2)
    far[candidates < 0] = np.inf
    order = np.argsort(far, 1, kind="stable")
    rows = np.arange(len(who))[:, None]
    candidates, far, x = candidates[rows, order], far[rows, order], x[rows, order]
    square = (x * x).sum(2)
    between = square[:, :, None] + square[:, None, :] - 2 * x @ x.transpose(0, 2, 1)
    alive, out = np.isfinite(far), np.full((len(who), degree), n, np.int64)
    each = np.arange(len(who))
    for k in range(degree):
        some = alive.any(1)
        if not some.any():
            break
        at = alive.argmax(1)
        out[some, k] = candidates[each, at][some]
        alive &= ~(alpha * between[each, at] <= far)
        alive[each, at] = False
    return out


def build(points, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 0):
    """``(graph, start)``: an array of out-edges of each point, n where unfilled, and the middle point."""
    import numpy as np

    points = points.astype(np.float32)
    n, rng = len(points), np.random.default_rng(seed)
    start = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    wide = 2 * degree
    graph = np.full((n + 1, wide), n, np.int64)
    if n > 1:
        graph[:n, : min(degree, n - 1)] = rng.integers(0, n, (n, min(degree, n - 1)))
    order = rng.permutation(n)
    for at in range(0, n, BATCH):
        who = order[at : at + BATCH]
        met, _, _ = beam_search(points, graph, start, points[who], beam, 2 * beam)
        old = np.where(graph[who] == n, -1, graph[who])
        chosen = prune(points, who, np.concatenate([met, old], 1), degree, alpha)
        graph[who] = n
        graph[who, :degree] = chosen
        row, col = np.nonzero(chosen < n)
        ends, back = chosen[row, col], who[row]
        by = np.argsort(ends, kind="stable")
        ends, back = ends[by], back[by]
        heads, first, counts = np.unique(ends, return_index=True, return_counts=True)
        most = int(counts.max(initial=0))
        new = np.full((len(heads), most), -1, np.int64)
        new[np.repeat(np.arange(len(heads)), counts), np.arange(len(ends)) - np.repeat(first, counts)] = back
        both = np.concatenate([np.where(graph[heads] == n, -1, graph[heads]), new], 1)
        both = np.sort(both, 1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        full = (both >= 0).sum(1) > wide
        if full.any():
            some = heads[full]
            for a in range(0, len(some), BATCH):
                graph[some[a : a + BATCH]] = n
                graph[some[a : a + BATCH], :degree] = prune(points, some[a : a + BATCH], both[full][a : a + BATCH], degree, alpha)
        kept = np.sort(np.where(both[~full] < 0, n, both[~full]), 1)[:, :wide]
        graph[heads[~full], : kept.shape[1]] = kept
        graph[heads[~full], kept.shape[1] :] = n
    return graph, start


INDEX = "dim int, band int, part long, n int, ids binary, codes binary, vectors binary, graph binary, start int"
FIELDS = [x.split()[0] for x in INDEX.split(", ")]


def lifted(v, band: int):
    """Points of a shard in single precision, brought to one norm near one by a last component."""
    import numpy as np

    scaled = np.ldexp(v, -BAND * band)
    norm = (scaled * scaled).sum(1)
    return np.column_stack([scaled, np.sqrt(np.maximum(norm.max() - norm, 0))]).astype(np.float32)


def _index(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32())
    for batch in batches:
        for k in range(batch.num_rows):
            dim, band, part = (batch.column(c)[k].as_py() for c in range(3))
            rows = batch.column(3)[k].values
            order = np.argsort(rows.field("id").to_numpy(), kind="stable")
            ids, codes, v = rows.field("id").to_numpy()[order], rows.field("code").to_numpy()[order], matrix(rows.field("v"))[order]
            graph, start = build(lifted(v, band), seed=part)
            cells = [dim, band, part, len(ids), ids.astype("<i8").tobytes(), codes.astype("<i8").tobytes(), v.astype("<f8").tobytes(), graph.astype("<u2" if len(ids) < 65535 else "<u4").tobytes(), start]
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, kinds, strict=True)], FIELDS)


class Index(NamedTuple):
    """Written tables: a row for each shard, and ``(point, code, id)`` of the rows that share their vector with others."""

    shards: DataFrame
    members: DataFrame


def _band() -> Column:
    """Which power of two, in steps of ``BAND``, the norm of ``v`` is nearest to; without overflow."""
    top = F.array_max(F.transform("v", F.abs))
    square = F.aggregate(F.transform("v", lambda x: x / top), F.lit(0.0), lambda s, x: s + x * x)
    return F.round((F.log2(top) + F.log2(square) / 2) / BAND).cast("int")


def index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD) -> Index:
    """The index of all usable rows.

    Rows that repeat an id and vector are one; an id with several vectors is found by each of them.
    Vectors of several lengths are indexed apart.  Columns but the two named ones are ignored.
    """
    every = usable(vectors, id_col, vector_col)
    points = every.groupBy("v").agg(F.min("id").alias("id"), (F.min("id") < F.max("id")).alias("shared"))
    rows = written(points.withColumns({"code": F.xxhash64("v"), "dim": F.size("v"), "band": _band()}), "points")
    shared = rows.where("shared").select("v", F.col("id").alias("point"), "code")
    members = written(every.join(shared, "v").select("point", "code", "id").distinct(), "graph-members")
    kinds = written(rows.groupBy("dim", "band").agg(F.greatest(F.lit(1), F.round(F.count("*") / shard)).cast("long").alias("parts")), "kinds")
    many = kinds.agg(F.coalesce(F.sum("parts"), F.lit(1))).first()[0]
    dealt = rows.join(kinds, ["dim", "band"]).select("dim", "band", F.pmod(F.xxhash64("id"), "parts").alias("part"), F.struct("id", "code", "v").alias("row"))
    grouped = dealt.groupBy("dim", "band", "part").agg(F.collect_list("row").alias("rows"))
    # Several tasks for each shard, so that few get two: a shard takes seconds to build and little room.
    spread = grouped.repartition(max(1, min(8 * many, 2000)), "dim", "band", "part")
    built = written(spread.mapInArrow(_index, INDEX), "graph-index")
    forget(rows, kinds)
    return Index(built, members)


def _query(k: int, beam: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                n, band, ids, codes, raw, graph, start, block = (batch.column(c)[row] for c in range(8))
                n, band, start, rows = n.as_py(), band.as_py(), start.as_py(), block.values
                ids, codes = np.frombuffer(ids.as_py(), "<i8"), np.frombuffer(codes.as_py(), "<i8")
                v = np.frombuffer(raw.as_py(), "<f8").reshape(n, -1)
                edges = np.frombuffer(graph.as_py(), f"<u{2 if n < 65535 else 4}").reshape(n + 1, -1).astype(np.int64)
                points, asked, q = lifted(v, band), rows.field("id").to_numpy(), matrix(rows.field("v"))
                for at in range(0, len(asked), BATCH):
                    some, who = q[at : at + BATCH], asked[at : at + BATCH]
                    unit = some / np.abs(some).max(1, keepdims=True)
                    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
                    met, _, seen = beam_search(points, edges, start, np.column_stack([unit, np.zeros(len(unit))]).astype(np.float32), beam, max(beam, k))
                    with np.errstate(over="ignore", invalid="ignore"):
                        score = np.einsum("rkd,rd->rk", v[np.maximum(met, 0)], some)
                    found = ids[np.maximum(met, 0)]
                    rank = np.where(met < 0, -np.inf, np.where(np.isnan(score), -np.inf, score))
                    order = np.lexsort((found, -rank, met < 0))[:, :k]
                    lines = np.arange(len(some))[:, None]
                    fine = met[lines, order] >= 0
                    take = lambda x: x[lines, order][fine]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.broadcast_to(x[:, None], fine.shape)[fine]) for x in (who,)] + [pa.array(take(found)), pa.array(take(codes[np.maximum(met, 0)])), pa.array(take(score)), pa.array(np.broadcast_to(seen[:, None], fine.shape)[fine])],
                        ["query_id", "point", "code", "score", "met"],
                    )

    return run


FOUND = "query_id long, point long, code long, score double, met long"


def walk(indexed: Index, queries: DataFrame, k: int = K, beam: int = SEARCH_BEAM, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 2048) -> DataFrame:
    """Rows ``FOUND``: for each query and shard the ``k`` best points, and how many points the walk met there."""
    asked = usable(queries, id_col, vector_col).distinct().withColumn("dim", F.size("v"))
    blocks = 1 + asked.count() // block
    grouped = asked.groupBy("dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("id", "v")).alias("rows"))
    # A table of its own, so that a join by few block numbers can be split.
    sent = written(grouped, "graph-queries")
    work = indexed.shards.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    pairs = work.join(sent, ["dim", "block"]).repartition(max(1, min(2000, blocks * 12)), "dim", "band", "part", "block")
    return pairs.select("n", "band", "ids", "codes", "vectors", "graph", "start", "rows").mapInArrow(_query(k, beam), FOUND)


def search(indexed: Index, queries: DataFrame, k: int = K, beam: int = SEARCH_BEAM, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 2048) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each query, ties to the smaller id.

    Only vectors of a query's own length are candidates, and a query's own id is never among them.
    Queries that are unusable have no rows; with fewer candidates than ``k`` all that the walks
    reach are returned.  A score beyond the range of doubles is infinite; one that is not a number,
    as the sum of two infinities, ranks last.  The queries are a stated set: they are cut into
    blocks, and each block is sent to every shard.
    """
    found = walk(indexed, queries, k + 1, beam, id_col, vector_col, block).drop("met")
    # One point more than asked for, and one row more of each: a query's own row may be among them.
    top = lambda df, n, by, *order: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)
    best = F.when(F.isnan("score"), float("-inf")).otherwise(F.col("score")).desc()
    points = top(found, k + 1, ["query_id"], best, "point", "code").drop("rank")
    members = top(indexed.members, k + 1, ["point", "code"], "id").drop("rank")
    near = points.join(members, ["point", "code"], "left").select("query_id", F.coalesce("id", "point").alias("vec_id"), "score").where("vec_id <> query_id")
    return top(near, k, ["query_id"], best, "vec_id").select("query_id", "rank", "vec_id", "score")
