"""Keyed matching: exact lookups, overlays, precedence, coverage by anti-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def index_match(rows: DataFrame, key: str, profile: DataFrame, profile_key: str, take: str, order: str, out: str = "found") -> DataFrame:
    """``rows`` with ``out`` and ``out_err``: the profile's value of the first row with the key, ``#N/A`` without.

    Of profile rows with one key the lowest ``order`` counts.  Adaptive execution chooses how to
    join by the profile's size.
    """
    first = profile.groupBy(F.col(profile_key).alias("__k")).agg(F.min_by(F.struct(F.col(take).alias("v")), order).alias("__v"))
    found = rows.join(first, rows[key] == first["__k"], "left")
    return found.withColumn(out, F.col("__v.v")).withColumn(f"{out}_err", F.when(F.col("__k").isNull(), "#N/A")).drop("__k", "__v")


def overlay(defaults: DataFrame, changes: DataFrame, keys: list[str], field: str) -> DataFrame:
    """``defaults`` with the values that ``changes`` names; a null change is one, too."""
    sparse = changes.select(*keys, F.struct(F.col(field).alias("v")).alias("__new"))
    found = defaults.join(sparse, keys, "left")
    return found.withColumn(field, F.when(F.col("__new").isNotNull(), F.col("__new.v")).otherwise(F.col(field))).drop("__new")


def unknown(changes: DataFrame, defaults: DataFrame, keys: list[str]) -> DataFrame:
    """Changes whose key is no default's; must be empty for a valid overlay."""
    return changes.join(defaults.select(*keys).distinct(), keys, "left_anti")


def missing(required: DataFrame, *sets: DataFrame, on: list[str]) -> DataFrame:
    """Required rows that none of the sets has."""
    for some in sets:
        required = required.join(some.select(*on), on, "left_anti")
    return required


def bound(rows: DataFrame, some: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key the other side has; each once, however often it has it."""
    return rows.join(some.select(*on), on, "left_semi")


def owner(owned: DataFrame, order: tuple[str, ...] = ("internal", "constant", "output", "input")) -> DataFrame:
    """``(address, series_id, direction)``: the owner by precedence of direction, then by id."""
    rank = F.array_position(F.array(*(F.lit(x) for x in order)), F.col("direction"))
    best = owned.groupBy("address").agg(F.min_by(F.struct("series_id", "direction"), F.struct(rank, "series_id")).alias("x"))
    return best.select("address", "x.*")


def contested(owned: DataFrame) -> DataFrame:
    """Addresses with more than one series of a direction."""
    return owned.groupBy("address", "direction").agg(F.count_distinct("series_id").alias("n")).where("n > 1")


def key_maps(owned: DataFrame, order: tuple[str, ...] = ("constant", "input", "output", "internal")) -> DataFrame:
    """``(address, key)``: the key map of the direction that comes last in ``order``."""
    rank = F.array_position(F.array(*(F.lit(x) for x in order)), F.col("direction"))
    return owned.groupBy("address").agg(F.max_by("key", F.struct(rank, "series_id")).alias("key"))


def unambiguous(rows: DataFrame, keys: list[str], spec: str) -> DataFrame:
    """``rows`` with ``spec`` null where several rows have the key."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return rows.withColumn(spec, F.when(n == 1, F.col(spec)))


def series_of(written: DataFrame, bound: DataFrame) -> DataFrame:
    """``(series_id, key, value)`` of values by address: the inverse of writing series to cells.

    ``bound(address, series_id, key)``; an address of several series gives a row for each, one of
    none gives none.
    """
    return written.join(bound.select("address", "series_id", "key"), "address").select("series_id", "key", "value")


def changed(before: DataFrame, after: DataFrame, keys: list[str], field: str, within: DataFrame | None = None) -> DataFrame:
    """Keys whose value is another than before; null is a value.

    ``within``: only keys that it has, as the closure of what was written.
    """
    if within is not None:
        after = bound(after, within, keys)
    old = before.select(*keys, F.col(field).alias("__old"))
    return after.join(old, keys).where(~F.col(field).eqNullSafe(F.col("__old"))).select(*keys, F.col("__old").alias("before"), F.col(field).alias("after"))


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """Keys of more than one row; must be empty where ownership is to be unique."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, with the side."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def ordered_union(*frames: DataFrame, key: str = "address", order: str = "ordinal") -> DataFrame:
    """Distinct keys of all frames with the first place each has."""
    every = frames[0].select(key, order)
    for f in frames[1:]:
        every = every.unionByName(f.select(key, order))
    return every.groupBy(key).agg(F.min(order).alias(order))
