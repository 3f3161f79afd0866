"""Differential comparison: the ladder, roll-ups, first divergence, ranked failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values

ATOL, RTOL = 1e-6, 1e-12


def _err(v: Column) -> Column:
    return F.coalesce(v["err"], F.when(F.trim(v["str"]).isin(*values.ERRORS), F.trim(v["str"])))


def verdict(golden: Column, sut: Column, atol: float = ATOL, rtol: float = RTOL) -> Column:
    """``struct<passed, outcome, matched_error, abs_diff, rel_diff>`` of two spreadsheet values.

    In this order: errors pass if of one class; two blanks pass, one fails; two flags by equality;
    numbers, a flag against a number being one: both NaN pass as a matched error, infinite ones by
    equality, finite ones by absolute or relative distance; whole numbers beyond a double's range,
    which are kept as digits, by equality; else equality of the texts.  Matched errors, blanks and
    NaN pass but are not healthy.
    """
    ge, se = _err(golden), _err(sut)
    g, s = (F.coalesce(v["num"], v["bool"].cast("double")) for v in (golden, sut))
    huge = lambda v: F.coalesce(v["str"].rlike(values.HUGE), F.lit(False))
    gap, rel = F.abs(g - s), values.relative_diff(g, s)
    infinite = lambda x: F.abs(x) == float("inf")
    blank_g, blank_s = values.is_blank(golden), values.is_blank(sut)
    nothing = F.lit(None).cast("double")

    def row(passed, outcome, matched=False, a=nothing, r=nothing) -> Column:
        return F.struct(F.coalesce(passed, F.lit(False)).alias("passed"), F.lit(outcome).alias("outcome"), F.lit(matched).alias("matched_error") if isinstance(matched, bool) else F.coalesce(matched, F.lit(False)).alias("matched_error"), a.cast("double").alias("abs_diff"), r.cast("double").alias("rel_diff"))

    numbers = g.isNotNull() & s.isNotNull()
    return (
        F.when(ge.isNotNull() | se.isNotNull(), row(ge == se, "error", ge == se))
        .when(blank_g & blank_s, row(F.lit(True), "matched_blank", False, F.lit(0.0), F.lit(0.0)))
        .when(blank_g | blank_s, row(F.lit(False), "one_blank"))
        .when(golden["bool"].isNotNull() & sut["bool"].isNotNull(), row(golden["bool"] == sut["bool"], "bool"))
        .when(numbers & F.isnan(g) & F.isnan(s), row(F.lit(True), "nan", True))
        .when(numbers & (F.isnan(g) | F.isnan(s)), row(F.lit(False), "nan"))
        .when(numbers & (infinite(g) | infinite(s)), row(g == s, "infinite"))
        .when(numbers, row((gap <= atol) | (rel <= rtol), "number", False, gap, rel))
        .when(huge(golden) & huge(sut), row(exact_integers(golden["str"], sut["str"]), "number"))
        .otherwise(row(golden["str"].eqNullSafe(sut["str"]) & golden["bool"].eqNullSafe(sut["bool"]) & g.eqNullSafe(s), "other"))
    )


def exact_integers(golden: Column, sut: Column) -> Column:
    """Whole numbers beyond a double's range, as texts of digits, compare exactly."""
    bare = lambda x: F.regexp_replace(x, r"^(-?)0+(?=\d)", "$1")
    return bare(golden) == bare(sut)


def compare(golden: DataFrame, sut: DataFrame, keys: list[str], expected: DataFrame | None = None) -> DataFrame:
    """Rows of both sides by key, a side that lacks one blank, with their verdicts.

    ``expected``: ``(scenario_id, expects_error_values)``; a matched error is flagged unless it
    was declared.
    """
    found = golden.withColumnRenamed("value", "golden").join(sut.withColumnRenamed("value", "sut"), keys, "full_outer")
    fill = lambda c: F.coalesce(F.col(c), values.value()).alias(c)
    found = found.select(*keys, fill("golden"), fill("sut")).withColumn("v", verdict(F.col("golden"), F.col("sut"))).select(*keys, "golden", "sut", "v.*")
    found = found.withColumn("healthy", F.col("passed") & ~F.col("matched_error") & ~F.col("outcome").isin("matched_blank", "error", "nan"))
    if expected is None:
        return found.withColumn("flagged_matched_error", F.col("matched_error"))
    found = found.join(expected, "scenario_id", "left")
    declared = F.coalesce("expects_error_values", F.lit(False))
    return found.withColumns({"flagged_matched_error": F.col("matched_error") & ~declared, "healthy": F.col("healthy") | (F.col("matched_error") & declared)}).drop("expects_error_values")


def crashed(scenario_id: str, cells: DataFrame, message: str, side: str = "sut") -> DataFrame:
    """A failing row for each output cell of a scenario whose evaluation broke off."""
    text, none = values.value(text=F.lit(message)), values.value()
    golden, sut = (none, text) if side == "sut" else (text, none)
    return cells.select(F.lit(scenario_id).alias("scenario_id"), "cell", golden.alias("golden"), sut.alias("sut"), F.lit(False).alias("passed"), F.lit("crash").alias("outcome"), F.lit(message).alias("note"))


def rollup(comparisons: DataFrame) -> DataFrame:
    """Counts in total, per axis, and per axis and point, in one grouping-sets pass."""
    n, passed, errors = F.count("*").alias("n"), F.count_if("passed").alias("n_passed"), F.count_if("matched_error").alias("n_matched_error")
    axis, point = F.col("axis"), F.col("point")
    return comparisons.groupingSets([[axis, point], [axis], []], axis, point).agg(n, passed, errors)


CSV = ("scenario_id", "axis", "point", "cell", "golden", "sut", "passed", "outcome", "matched_error", "abs_diff", "rel_diff")


def csv_rows(comparisons: DataFrame) -> DataFrame:
    """The comparison report's columns, ``CSV``, values as texts; ``write.csv(header=True)`` makes the file.

    Columns that ``comparisons`` lacks are empty.
    """
    text = lambda c: F.coalesce(F.col(c)["err"], F.col(c)["str"], F.col(c)["bool"].cast("string"), values.coerced(F.col(c)["num"])).alias(c)
    return comparisons.select(*(text(c) if c in ("golden", "sut") else F.col(c) if c in comparisons.columns else F.lit(None).cast("string").alias(c) for c in CSV))


def first_divergence(comparisons: DataFrame, order: list[str]) -> DataFrame:
    """The failing row that comes first; no row if all pass."""
    rest = [c for c in comparisons.columns if c not in order]
    found = comparisons.where(~F.col("passed")).agg(F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("x"))
    return found.where("x IS NOT NULL").select("x.*")


def top_failures(comparisons: DataFrame, keys: list[str], n: int = 50) -> DataFrame:
    """The ``n`` failures that are farthest off, distances unknown last, ties by key."""
    return comparisons.where(~F.col("passed")).orderBy(F.coalesce("abs_diff", F.lit(0.0)).desc(), *keys).limit(n)


def exit_code(comparisons: DataFrame, errors: int = 0) -> int:
    """0: all pass and no matched error is flagged; 1: some do not; 2: the run itself failed."""
    if errors:
        return 2
    bad = comparisons.agg(F.count_if(~F.col("passed") | F.col("flagged_matched_error")).alias("n")).first()["n"]
    return int(bad > 0)


def absent_inputs(writes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(address, n_scenarios)``: written addresses that are no nodes of the graph, and how many scenarios write them."""
    known = nodes.select(F.col(nodes.columns[0]).alias("address"))
    return writes.join(known, "address", "left_anti").groupBy("address").agg(F.count_distinct("scenario_id").alias("n_scenarios"))


def report(comparisons: DataFrame, title: str, keys: list[str], absent: DataFrame | None = None) -> str:
    """The text report: header, totals, per axis, absent inputs, first divergence, ranked failures with how many are left out.

    ``absent`` has the rows of :func:`absent_inputs`, one for an input cell of the model.
    """
    rows = rollup(comparisons).collect()  # a row for each axis and point
    total = next(r for r in rows if r["axis"] is None and r["point"] is None)
    n, passed = total["n"], total["n_passed"]
    lines = [title, f"passed: {passed}/{n} ({100 * passed / n:.2f}%)" if n else "passed: 0/0", f"matched errors: {total['n_matched_error']}", "PER-AXIS"]
    lines += [f"{r['axis']}: {r['n_passed']}/{r['n']}" for r in sorted(rows, key=lambda r: str(r["axis"])) if r["axis"] is not None and r["point"] is None]
    lines += ["PER-POINT"] + [f"{r['axis']} {r['point']}: {r['n_passed']}/{r['n']}" for r in sorted(rows, key=lambda r: (str(r["axis"]), str(r["point"]))) if r["point"] is not None]
    if absent is not None:
        lines += ["ABSENT INPUTS"] + ([f"{r['address']}: {r['n_scenarios']} scenarios" for r in absent.orderBy("address").collect()] or ["none"])
    first = first_divergence(comparisons, keys).collect()
    lines.append("first divergence: " + (" ".join(str(first[0][k]) for k in keys) if first else "none"))
    lines += [" ".join(str(r[k]) for k in keys) + f" abs_diff={r['abs_diff']}" for r in top_failures(comparisons, keys).collect()]
    if n - passed > 50:
        lines.append(f"and {n - passed - 50} more")
    return "\n".join(lines) + "\n"


def parse_report(text: str, required: tuple[str, ...] = ("passed",)) -> dict[str, str]:
    """The ``key: value`` lines of a report; ValueError if a required one is missing."""
    found = dict(line.split(": ", 1) for line in text.splitlines() if ": " in line)
    if lacking := [k for k in required if k not in found]:
        raise ValueError(f"report lacks {lacking}")
    return found
