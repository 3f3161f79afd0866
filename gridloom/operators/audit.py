"""Workbook audit counts, ranking and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import address, values


def kind(text: Column) -> Column:
    """Kind of a cell by its raw text: blank, formula, error or value."""
    return F.when(text.isNull() | (text == ""), "blank").when(text.startswith("="), "formula").when(text.isin(*values.ERRORS), "error").otherwise("value")


def totals(cells: DataFrame) -> DataFrame:
    """Cells of each kind per sheet."""
    count = lambda k: F.count_if(F.col("kind") == k).alias(f"n_{k}")
    return cells.groupBy("sheet").agg(F.count("*").alias("n_cells"), count("formula"), count("value"), count("error"), count("blank"), F.count_if(address.external(F.col("formula"))).alias("n_external"))


def largest(totals_: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` sheets with most cells, ties by name."""
    return totals_.orderBy(F.desc("n_cells"), "sheet").limit(n)


def report(totals_: DataFrame, functions: DataFrame, names: DataFrame, title: str = "Workbook Audit") -> str:
    """The audit as Markdown: totals, largest sheets, functions by use, names by use.  One row per sheet, function and name is read."""
    sheets = totals_.orderBy("sheet").collect()
    lines = [f"# {title}", "", "| sheet | cells | formulas | values | errors | blanks | external |", "|-|-|-|-|-|-|-|"]
    lines += [f"| {r['sheet']} | {r['n_cells']} | {r['n_formula']} | {r['n_value']} | {r['n_error']} | {r['n_blank']} | {r['n_external']} |" for r in sheets]
    lines += ["", "## Largest sheets", ""] + [f"{k}. {r['sheet']}: {r['n_cells']} cells" for k, r in enumerate(largest(totals_).collect(), 1)]
    lines += ["", "## Functions", ""] + [f"- {r['function']}: {r['n_calls']} calls in {r['n_formulas']} formulas{' (dynamic)' if r['dynamic'] else ''}" for r in functions.orderBy(F.desc("n_calls"), "function").collect()]
    lines += ["", "## Names", ""] + [f"- {r['name']}: {r['n_formulas']} formulas" for r in names.orderBy(F.desc("n_formulas"), "name").collect()]
    return "\n".join(lines) + "\n"


def function_calls(formulas: DataFrame, id_col: str = "id", formula_col: str = "formula") -> DataFrame:
    """``(function, n_calls, n_formulas, dynamic)``."""
    calls = formulas.select(id_col, F.explode(address.function_names(F.col(formula_col))).alias("function"))
    each = calls.groupBy("function", id_col).agg(F.count("*").alias("n"))  # a formula once per function, before the count
    return each.groupBy("function").agg(F.sum("n").alias("n_calls"), F.count("*").alias("n_formulas")).withColumn("dynamic", F.col("function").isin(*values.DYNAMIC))


def name_usage(formulas: DataFrame, names: DataFrame, formula_col: str = "formula") -> DataFrame:
    """``(name, n_formulas)``: formulas that hold a name as a word, once each, without regard to case.

    Formulas are cut into words and joined to the names, so the work grows with the words, not
    with names times formulas.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(formula_col), F.lit(r"[a-z_\\][a-z0-9_.\\]*"), F.lit(0)))
    used = formulas.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    found = names.select("name").distinct().join(used, F.lower("name") == F.col("w"), "left")
    return found.select("name", F.coalesce("n", F.lit(0).cast("long")).alias("n_formulas"))


def reference_counts(formulas: DataFrame, formula_col: str = "formula") -> DataFrame:
    """``(address, n)``: how often formulas name each cell, dollar signs ignored."""
    cells = F.regexp_extract_all(F.upper(F.replace(F.col(formula_col), F.lit("$"), F.lit(""))), F.lit(r"(?<![A-Z0-9_.])([A-Z]{1,3}[0-9]+)(?![A-Z0-9_(.])"), F.lit(1))
    return formulas.select(F.explode(cells).alias("address")).groupBy("address").agg(F.count("*").alias("n"))


def difficulty(edges: DataFrame, most: int = 300) -> DataFrame:
    """``(parent, n_deps, n_special, n_sheets)`` of parents with at most so many dependencies, hardest first."""
    special = F.array_contains("causes", "dynamic_offset") | F.array_contains("causes", "dynamic_indirect") | F.col("guard").isNotNull()
    other = F.when(F.col("child_sheet") != F.col("parent_sheet"), F.col("child_sheet"))
    found = edges.groupBy("parent").agg(F.count("*").alias("n_deps"), F.count_if(special).alias("n_special"), F.count_distinct(other).alias("n_sheets"))
    return found.where(F.col("n_deps") <= most).orderBy(F.desc("n_special"), F.desc("n_sheets"), F.desc("n_deps"), "parent")


def sample(rows: DataFrame, key: str, n: int, required: DataFrame | None = None, seed: str = "0") -> DataFrame:
    """``n`` rows: the required ones first, then in the order of a hash of seed and key; the same each time."""
    order = F.md5(F.concat(F.lit(seed), F.lit(":"), F.col(key).cast("string")).cast("binary"))
    if required is None:
        return rows.orderBy(order, key).limit(n)
    pins = required.select(F.col(key).alias("__pin")).distinct()
    found = rows.join(pins, rows[key] == pins["__pin"], "left")
    return found.orderBy(F.col("__pin").isNull(), order, key).limit(n).drop("__pin")


def budget(children: DataFrame, n: int = 300) -> DataFrame:
    """For each parent its first ``n`` children, those that its formula names first."""
    place = F.row_number().over(Window.partitionBy("parent").orderBy(F.desc("referenced"), "child"))
    return children.withColumn("__n", place).where(F.col("__n") <= n).drop("__n")


def timings(spans: DataFrame) -> DataFrame:
    """``(stage, seconds, outcome)``: total time, and the cache outcome seen last."""
    return spans.groupBy("stage").agg(F.sum("seconds").alias("seconds"), F.max_by("outcome", "seq").alias("outcome"))
