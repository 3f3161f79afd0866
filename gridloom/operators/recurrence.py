"""First-order recurrences over ordered periods.

The state feeds itself, so no window function computes it.  A series is an array, in order, and the
recurrence a fold over it, inside one projection.  Series are split from each other, never in
themselves: :func:`series` needs one key's periods to fit a task.  Where one key may hold a large
share of all rows, :func:`blocked_path` cuts it into blocks; a step is an affine map of the state,
so blocks are composed first, in parallel, and a second pass starts each block from its state.
That pass gives every step, equal to the fold up to rounding in a block's composition.

An array that grows is copied whenever an element is put to it, so folds fill pieces of ``PIECE``
states, and only the list of pieces grows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import shared

PIECE = 64
STEP = "struct<r:double,g:double,p:double>"


def step(state: Column, r: Column, g: Column, p: Column) -> Column:
    """``d (1 + r / 100) / (1 + g / 100) - p``; null where growth is -100."""
    return F.try_divide(state * (1 + r / 100), 1 + g / 100) - p


def path(start: Column, steps: Column) -> Column:
    """Every state after the first, of an array of structs ``r, g, p``."""
    return scan(start, steps, lambda d, s: step(d, s["r"], s["g"], s["p"]))


def scan(start: Column, steps: Column, turn: Callable[[Column, Column], Column]) -> Column:
    """The states ``turn(state, step)`` after each element of ``steps``; null without an array."""
    begin = start.cast("double")
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.size(steps) / PIECE).cast("int")), lambda k: F.slice(steps, k * PIECE + 1, F.lit(PIECE)))

    def put(acc: Column, piece: Column) -> Column:
        # A piece's first state is the last one before it; it is taken off once the piece is full.
        now = F.when(F.size(acc) == 0, begin).otherwise(F.element_at(F.element_at(acc, -1), -1))
        filled = F.aggregate(piece, F.array(now), lambda some, s: F.concat(some, F.array(turn(F.element_at(some, -1), s))), lambda some: F.slice(some, 2, F.size(piece)))
        return F.when(F.size(piece) == 0, acc).otherwise(F.concat(acc, F.array(filled)))

    return F.flatten(F.aggregate(pieces, F.array().cast("array<array<double>>"), put))


def last(start: Column, steps: Column) -> Column:
    """The last state; the start without steps."""
    return F.aggregate(steps, start, lambda d, s: step(d, s["r"], s["g"], s["p"]))


def prior(rows: DataFrame, key: str, order: list[str], field: str, out: str = "prior") -> DataFrame:
    """``rows`` with the field of the period before; null for a key's first."""
    return rows.withColumn(out, F.lag(field).over(Window.partitionBy(key).orderBy(*order)))


def active(periods: Column, threshold: Column) -> Column:
    """One from the threshold period on, zero before."""
    return F.transform(periods, lambda t: F.when(t >= threshold, 1).otherwise(0))


def series(rows: DataFrame, key: str, order: list[str], *fields: Column) -> DataFrame:
    """``(key, s)``: an array of structs of ``fields`` in the order of ``order``."""
    packed = F.struct(*(F.col(c).alias(f"__o{k}") for k, c in enumerate(order)), *fields)
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(packed)).alias("s"))


def blocked_path(rows: DataFrame, key: str, order: list[str], r: str, g: str, p: str, start: Column, block: int = 4096) -> DataFrame:
    """``(key, n, state)``: the state after every step, for series of any length.

    ``block`` periods are a unit of work.  ``start`` is a column of ``rows`` that is the same for
    all periods of a key.  Rows are numbered by range partitions: each partition's rows of a key
    follow each other, so a row's number is its place there and the key's rows before.  Only a
    key's block maps, two numbers for ``block`` rows, come together in one task.
    """
    spark = rows.sparkSession
    places = [f"o{k}" for k in range(len(order))]
    taken = rows.select(F.col(key).alias("k"), *(F.col(c).alias(o) for c, o in zip(order, places, strict=True)), *(F.col(c).cast("double").alias(x) for c, x in ((r, "r"), (g, "g"), (p, "p"))), start.cast("double").alias("d0"))
    sorted_ = taken.repartitionByRange("k", *places).sortWithinPartitions("k", *places).select("k", "r", "g", "p", "d0", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id"))
    dealt = spark.read.schema(sorted_.schema).parquet(shared.write(sorted_, "periods"))
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = dealt.groupBy("k", "part").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    runs = runs.select(F.col("k").alias("rk"), F.col("part").alias("rpart"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    runs = spark.read.schema(runs.schema).parquet(shared.write(runs, "runs"))
    numbered = dealt.join(runs, F.col("k").eqNullSafe(F.col("rk")) & (F.col("part") == F.col("rpart"))).withColumn("n", F.col("id") + F.col("shift"))
    cut = numbered.withColumn("b", F.floor((F.col("n") - 1) / block)).groupBy("k", "b").agg(F.first("d0").alias("d0"), F.array_sort(F.collect_list(F.struct("n", "r", "g", "p"))).alias("s"))
    whole = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("c"))
    factor = lambda s: F.try_divide(1 + s["r"] / 100, 1 + s["g"] / 100)
    cut = cut.withColumn("map", F.aggregate("s", whole, lambda acc, s: F.struct((acc["a"] * factor(s)).alias("a"), (acc["c"] * factor(s) - s["p"]).alias("c"))))
    blocks = spark.read.schema(cut.schema).parquet(shared.write(cut, "blocks"))
    maps = blocks.groupBy("k").agg(F.min_by("d0", "b").alias("d0"), F.array_sort(F.collect_list(F.struct("b", "map"))).alias("m"))
    ends = scan(F.col("d0"), F.col("m"), lambda d, m: d * m["map"]["a"] + m["map"]["c"])
    starts = maps.select(F.col("k").alias("sk"), F.posexplode(F.concat(F.array("d0"), ends)).alias("sb", "from"))  # the last end starts no block
    starts = spark.read.schema(starts.schema).parquet(shared.write(starts, "starts"))
    begun = blocks.join(starts, F.col("k").eqNullSafe(F.col("sk")) & (F.col("b") == F.col("sb")))
    states = begun.select("k", "b", F.posexplode(path(F.col("from"), F.col("s"))).alias("i", "state"))
    return states.select(F.col("k").alias(key), (F.col("b") * block + F.col("i") + 1).alias("n"), "state")
