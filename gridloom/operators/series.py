"""Series as arrays and maps: strict accessors that fail closed.

Each accessor has a form that raises, for plans that must not go on, and a column that says what is
wrong, for tables in which wrong rows are to be listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def length_error(*arrays: Column) -> Column:
    """Null if all arrays have one length, else a message."""
    same = F.lit(True)
    for a in arrays[1:]:
        same &= F.size(arrays[0]) == F.size(a)
    sizes = F.concat_ws(", ", *(F.size(a).cast("string") for a in arrays))
    return F.when(~F.coalesce(same, F.lit(False)), F.concat(F.lit("lengths differ: "), sizes))


def _strict(value: Column, error: Column) -> Column:
    return F.when(error.isNull(), value).otherwise(F.raise_error(error))


def zipped(**arrays: Column) -> Column:
    """Array of structs of the arrays, in order; an error if their lengths differ."""
    parts = list(arrays.values())
    return _strict(F.arrays_zip(*(c.alias(k) for k, c in arrays.items())), length_error(*parts))


def key_error(series: Column, key: Column) -> Column:
    return F.when(~F.coalesce(F.map_contains_key(series, key), F.lit(False)), F.concat(F.lit("no value for "), F.coalesce(key.cast("string"), F.lit("null"))))


def selected(series: Column, key: Column) -> Column:
    """The value at a key; an error if the series has not the key.  A null value is a value."""
    return _strict(F.element_at(series, key), key_error(series, key))


def missing_keys(series: Column, axis: Column) -> Column:
    """Keys of an axis that a series lacks, in the axis' order."""
    return F.filter(axis, lambda k: ~F.map_contains_key(series, k))


def ordered_values(series: Column, axis: Column) -> Column:
    """Values in the order of an axis; an error if a key is missing.  Keys outside the axis do not count."""
    lacking = missing_keys(series, axis)
    found = F.transform(axis, lambda k: F.element_at(series, k))
    return _strict(found, F.when(F.size(lacking) > 0, F.concat(F.lit("missing keys "), F.array_join(lacking, ", "))))


def same_axes(key_fields: Column, axes: Column) -> Column:
    """Whether two lists name the same fields, in any order."""
    return F.array_sort(F.array_distinct(key_fields)) == F.array_sort(F.array_distinct(axes))


def plain_keys(entries: Column) -> Column:
    """Entries of a map of JSON texts whose values are strings, numbers or flags; lists, objects and nulls go."""
    return F.map_filter(entries, lambda k, v: v.isNotNull() & ~v.rlike(r"^\s*(\[|\{|null\s*$)"))


def overridden(values: Column, place: Column, value: Column) -> Column:
    """The array with one element, counted from zero, replaced; a place outside it changes nothing."""
    return F.transform(values, lambda x, k: F.when(k == place, value).otherwise(x))


def catalogue(outputs: DataFrame, specs: DataFrame) -> DataFrame:
    """``(compute, label, value, err)``: outputs laid on the specs of their compute by place.

    ``outputs(compute, values)``, ``specs(compute, ordinal, label)``, ordinals from zero.  A compute
    without outputs, and one whose length is not the number of its specs, has an error in all its rows.
    """
    n = specs.groupBy("compute").agg(F.count("*").alias("n"))
    found = specs.join(n, "compute").join(outputs, "compute", "left")
    error = F.when(F.col("values").isNull(), F.concat(F.lit("no values returned for "), "compute")).when(
        F.size("values") != F.col("n"), F.concat_ws(" ", "compute", F.lit("returned"), F.size("values").cast("string"), F.lit("values for"), F.col("n").cast("string"), F.lit("cells"))
    )
    return found.select("compute", "label", F.when(error.isNull(), F.get("values", F.col("ordinal"))).alias("value"), error.alias("err"))


def label_failures(references: DataFrame, literals: DataFrame, scenario_values: DataFrame) -> DataFrame:
    """``(input, value, failure)`` of labels that do not resolve.

    All three have columns ``(input, value)``.  Literals must equal a reference label; scenario
    values may differ in white space around them, if that leaves one label.
    """
    known = references.select("input").distinct()
    lacking = lambda df, what: df.join(known, "input", "left_anti").select("input", F.lit(None).cast("string").alias("value"), F.lit(f"no reference labels for {what}").alias("failure")).distinct()
    strange = literals.join(known, "input", "left_semi").join(references, ["input", "value"], "left_anti").select("input", "value", F.lit("literal is no reference label").alias("failure"))
    exact = scenario_values.join(known, "input", "left_semi").distinct().join(references, ["input", "value"], "left_anti")
    choices = references.distinct().groupBy("input", F.trim("value").alias("bare")).agg(F.count("*").alias("n"))
    loose = exact.withColumn("bare", F.trim("value")).join(choices, ["input", "bare"], "left")
    wrong = loose.where("n IS NULL OR n > 1").select("input", "value", F.when(F.col("n").isNull(), "unknown label").otherwise("ambiguous label").alias("failure"))
    return lacking(literals, "a literal").unionByName(strange).unionByName(lacking(scenario_values, "a scenario value")).unionByName(wrong)
