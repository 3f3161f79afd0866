"""Cell addresses: parsing, rendering, ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_number(letters: Column) -> Column:
    """A is 1, Z is 26, AA is 27; null for anything else."""
    chars = F.split(F.upper(letters), "")
    total = F.aggregate(chars, F.lit(0), lambda acc, c: acc * 26 + F.ascii(c) - 64)
    return F.when(letters.rlike("^[A-Za-z]{1,3}$"), total)


def column_letters(n: Column) -> Column:
    """The letters of a column number from 1 to 18278 (ZZZ); null outside."""
    n = n.cast("int")
    char = lambda x: F.char((x + 64).cast("int"))
    a, b, c = (n - 703) / 676, (n - 27) / 26, (n - 1) % 26 + 1
    two = F.concat(char((F.floor(b).cast("int") % 26) + 1), char(c))
    return F.when((n < 1) | (n > 18278), None).when(n <= 26, char(c)).when(n <= 702, two).otherwise(F.concat(char(F.floor(a) + 1), two))


_CELL = r"^(?:(?:'((?:[^']|'')*)'|([^'!]+))!)?\$?([A-Za-z]{1,3})\$?([0-9]+)$"


def sheet_of(address: Column, default: str = "Workbook") -> Column:
    quoted, bare = F.regexp_extract(address, _CELL, 1), F.regexp_extract(address, _CELL, 2)
    return F.coalesce(F.nullif(F.replace(quoted, F.lit("''"), F.lit("'")), F.lit("")), F.nullif(bare, F.lit("")), F.lit(default))


def parsed(address: Column, default: str = "Workbook") -> Column:
    """``struct<sheet, row, col>``; null if the text is no address."""
    row = F.regexp_extract(address, _CELL, 4).try_cast("int")
    col = column_number(F.regexp_extract(address, _CELL, 3))
    return F.when(address.rlike(_CELL) & (row > 0), F.struct(sheet_of(address, default).alias("sheet"), row.alias("row"), col.alias("col")))


def quoted(sheet: Column) -> Column:
    plain = sheet.rlike("^[A-Za-z_][A-Za-z0-9_]*$")
    return F.when(plain, sheet).otherwise(F.concat(F.lit("'"), F.replace(sheet, F.lit("'"), F.lit("''")), F.lit("'")))


def rendered(sheet: Column, row: Column, col: Column) -> Column:
    return F.concat(quoted(sheet), F.lit("!"), column_letters(col), row.cast("string"))


def normalised(address: Column) -> Column:
    """One spelling for an address: no dollar signs, upper-case letters, quotes where needed."""
    p = parsed(address)
    return rendered(p["sheet"], p["row"], p["col"])


def corners(range_text: Column) -> Column:
    """``struct<r1, c1, r2, c2>`` of ``A1:B2`` or ``A1``, corners in any order."""
    bare = F.upper(F.replace(F.element_at(F.split(range_text, "!"), -1), F.lit("$"), F.lit("")))
    first, last = F.split_part(bare, F.lit(":"), F.lit(1)), F.when(bare.contains(":"), F.split_part(bare, F.lit(":"), F.lit(2))).otherwise(bare)
    row = lambda x: F.regexp_extract(x, "([0-9]+)$", 1).try_cast("int")
    col = lambda x: column_number(F.regexp_extract(x, "^([A-Z]+)", 1))
    return F.struct(F.least(row(first), row(last)).alias("r1"), F.least(col(first), col(last)).alias("c1"), F.greatest(row(first), row(last)).alias("r2"), F.greatest(col(first), col(last)).alias("c2"))


def expanded(ranges: DataFrame, range_col: str = "range") -> DataFrame:
    """A row for each cell of a range, row by row, with columns ``row`` and ``col``."""
    found = ranges.withColumn("__k", corners(F.col(range_col)))
    found = found.withColumn("row", F.explode(F.sequence("__k.r1", "__k.r2")))
    return found.withColumn("col", F.explode(F.sequence("__k.c1", "__k.c2"))).drop("__k")


def range_text(r1: Column, c1: Column, r2: Column, c2: Column) -> Column:
    first, last = F.concat(column_letters(c1), r1.cast("string")), F.concat(column_letters(c2), r2.cast("string"))
    return F.when(first == last, first).otherwise(F.concat_ws(":", first, last))


def truncated(text: Column, most: int) -> Column:
    """``struct<text, truncated>``: longer texts are cut and end in three dots."""
    long = F.length(text) > most
    return F.struct(F.when(long, F.concat(F.left(text, F.lit(most - 3)), F.lit("..."))).otherwise(text).alias("text"), long.alias("truncated"))


def header(text: Column, normalise: str = "strip") -> Column:
    """A label as a key: trimmed, and for ``strip_trailing_unit`` without a unit in brackets at its end."""
    bare = F.trim(text)
    return F.regexp_replace(bare, r"\s*\([^)]*\)$", "") if normalise == "strip_trailing_unit" else bare


def mentions(formula: Column, cell: Column) -> Column:
    """Whether a formula's text holds an address, without regard to case and dollar signs; A1 also is in A10."""
    bare = lambda x: F.upper(F.replace(x, F.lit("$"), F.lit("")))
    return F.contains(bare(formula), bare(cell))


def function_names(formula: Column) -> Column:
    """Every function call of a formula, in order, repeats included; no letter, digit or underscore is before a name, so `_xlfn.XLOOKUP(` is XLOOKUP."""
    return F.regexp_extract_all(F.upper(formula), F.lit(r"(?<![A-Z0-9_])([A-Z][A-Z0-9_.]*)\("), F.lit(1))


def external(formula: Column) -> Column:
    return formula.rlike(r"\[[^\]]+\]")


def resolved_label(wanted: Column, choices: Column) -> Column:
    """``struct<label, err>``: the equal choice, else the one equal when trimmed, else the one it begins."""
    exact = F.filter(choices, lambda c: c == wanted)
    trimmed = F.filter(choices, lambda c: F.trim(c) == F.trim(wanted))
    begins = F.filter(choices, lambda c: F.startswith(F.trim(c), F.trim(wanted)))
    pick = F.when(F.size(exact) > 0, F.slice(exact, 1, 1)).when(F.size(trimmed) > 0, trimmed).otherwise(begins)
    return F.struct(F.when(F.size(pick) == 1, F.get(pick, F.lit(0))).alias("label"), F.when(F.size(pick) == 0, "unknown").when(F.size(pick) > 1, "ambiguous").alias("err"))


def resolved_labels(rows: DataFrame, wanted: str, choices: DataFrame) -> DataFrame:
    """``rows`` with ``label`` and ``err`` as :func:`resolved_label` gives them, matched by keys.

    ``choices`` has a column ``choice``.  Each distinct choice is a row for each length of its
    beginnings, so that a wanted label that begins a choice is an equi-join too; the shortest kind
    of match that there is counts.
    """
    every = choices.select("choice").where("choice IS NOT NULL").distinct()
    bare = F.trim("choice")
    exact = every.select(F.col("choice").alias("k"), "choice", F.lit(0).alias("rank"))
    trimmed = every.select(bare.alias("k"), "choice", F.lit(1).alias("rank"))
    begun = every.select(F.explode(F.transform(F.sequence(F.lit(0), F.length(bare)), lambda n: F.left(bare, n))).alias("k"), "choice", F.lit(2).alias("rank"))
    asked = rows.select(F.col(wanted).alias("__wanted")).where("__wanted IS NOT NULL").distinct()
    plain = F.trim("__wanted")
    hits = asked.join(exact, F.col("__wanted") == F.col("k")).unionByName(asked.join(trimmed.unionByName(begun), plain == F.col("k")))
    best = hits.groupBy("__wanted", "rank").agg(F.count_distinct("choice").alias("n"), F.min("choice").alias("choice")).groupBy("__wanted").agg(F.min_by(F.struct("n", "choice", "rank"), "rank").alias("b"))
    found = rows.join(best, rows[wanted] == best["__wanted"], "left")
    one = F.col("b.n") == 1
    return found.select(*rows.columns, F.when(one, F.col("b.choice")).alias("label"), F.when(F.col("b").isNull(), "unknown").when(~one, "ambiguous").alias("err"))
