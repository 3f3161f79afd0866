"""Connected components of a link table, by alternating star contraction.

The links stay distributed.  Each round first hooks every larger neighbour of a node to the
smallest node it sees, then every smaller one; the rounds needed grow with the logarithm of the
longest path.  A hub has one row per link and its minimum is pre-aggregated before the shuffle.
The minima are a table of their own: an aggregate in the stage of the join that follows would
keep adaptive execution from splitting a hub, and no join broadcasts them.  Every round is a written table, so no round
depends on executors of an earlier one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, sorted_join, written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    hooked = both.join(sorted_join(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return _then(hooked, least)


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    hooked = down.join(sorted_join(least), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _then(hooked.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), least)


def _then(links: DataFrame, used: DataFrame) -> DataFrame:
    found = written(links, "links")
    forget(used)
    return found


def components(edges: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` for every node with a link; ``root`` is the smallest of its component.

    ``edges`` has two long columns ``a`` and ``b``.  Rows with a null and loops are no links.  No
    links: an empty table.  Repeated links count once.
    """
    edges = edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).where("a <> b")
    now = written(edges.select("a", "b").distinct(), "links")
    state = _state(now)
    while state[0]:
        large = _large_star(now)
        new = _small_star(large)
        forget(now, large)
        now, before, state = new, state, _state(new)
        if state == before:
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
