"""The scenario sweep: one input configuration per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The model's countries, defaults and sweep axes.
COUNTRIES = {"Borvelia": 60.0, "Litellia": 80.0, "Aurelium": 40.0}
GROWTH, INTEREST, BALANCE = [3.5] * 5, [4.0] * 5, [-1.0, -0.5, 0.0, 0.5, 1.0]
SHOCK_YEAR, SHOCK_TYPE, MAGNITUDES = 2, 1, [-2.0, 2.0, -1.0]
PARAMETERS = {"growth": [0.0, 1.5, 3.5, 5.5, 7.0], "interest": [0.0, 2.0, 4.0, 6.0, 8.0], "primary_balance": [-3.0, -1.5, 0.0, 1.5, 3.0]}
SHOCKS = ("baseline", "growth", "interest", "primary_balance")

SCHEMA = (
    "scenario_id string, grp string, axis string, point string, country_name string, growth array<double>, interest array<double>, balance array<double>, "
    "shock_year double, shock_type double, shock_table array<double>, expects_error_values boolean"
)


def _row(scenario_id, grp, axis, point, country="Borvelia", growth=GROWTH, interest=INTEREST, balance=BALANCE, year=SHOCK_YEAR, kind=SHOCK_TYPE, table=(0.0, 0.0, 0.0), errors=False):
    cast = lambda xs: [None if x is None else float(x) for x in xs]
    return (scenario_id, grp, axis, point, country, cast(growth), cast(interest), cast(balance), float(year) if year is not None else None, float(kind) if kind is not None else None, cast(table), errors)


def defaults(spark: SparkSession) -> DataFrame:
    """The shipped model's own inputs."""
    return spark.createDataFrame([_row("default", "default", "default", "default", table=MAGNITUDES)], SCHEMA)


def sweep(spark: SparkSession, errors: bool = True) -> DataFrame:
    """The 118 scenarios, and unless told otherwise those that end in errors or odd numbers, with their order."""
    rows = []
    for country in COUNTRIES:
        for k, name in enumerate(SHOCKS):
            table = [m if k == j + 1 else 0.0 for j, m in enumerate(MAGNITUDES)]
            rows.append(_row(f"canonical:{country}:{name}", "canonical", "canonical", name, country, kind=max(k, 1), table=table))
    single = lambda axis, point, **kw: rows.append(_row(f"single_axis:{axis}={point}", "single_axis", axis, str(point), **kw))
    for country in COUNTRIES:
        single("country", country, country=country)
    for year in range(1, 6):
        single("shock_year", year, year=year, table=(-2, 0, 0))
    for kind in (1, 2, 3):
        single("shock_type", kind, kind=kind, table=MAGNITUDES)
    for m in range(-3, 2):
        single("growth_shock_magnitude", f"{m:+.1f}", table=(m, 0, 0))
    for name, base in (("growth", GROWTH), ("interest", INTEREST), ("primary_balance", BALANCE)):
        for year in (1, 3, 5):
            for x in PARAMETERS[name]:
                changed = [x if k == year - 1 else b for k, b in enumerate(base)]
                single(f"{name}[year={year}]", f"{x:+.1f}", **{"balance" if name == "primary_balance" else name: changed})
    for country in COUNTRIES:
        for kind in (1, 2, 3):
            for year in range(1, 6):
                rows.append(_row(f"combo:country={country}:shock_type={kind}:shock_year={year}", "combo", "combo", country, country, kind=kind, year=year, table=MAGNITUDES))
    if errors:
        odd = lambda name, bad=True, **kw: rows.append(_row(f"error:{name}", "error", "error", name, errors=bad, **({"table": MAGNITUDES} | kw)))
        odd("unknown_country", country="Atlantis")
        odd("trailing_space", country="Borvelia ")
        odd("shock_type_0", kind=0)
        odd("shock_type_4", kind=4)
        odd("shock_year_0", False, year=0)
        odd("shock_year_6", False, year=6)
        odd("shock_year_2.5", False, year=2.5)
        odd("growth_minus_100", growth=[3.5, 3.5, -100.0, 3.5, 3.5])
        odd("blank_input", False, interest=[None, 4.0, 4.0, 4.0, 4.0])
        odd("nan", False, balance=[0.0, float("nan"), 0.0, 0.0, 0.0])
        odd("infinite", False, balance=[0.0, float("inf"), 0.0, 0.0, 0.0])
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"ord int, {SCHEMA}")
    return frame.coalesce(1) if len(rows) < 1000 else frame


def draws(spark: SparkSession, n: int = 5, seed: int = 0) -> DataFrame:
    """Random scenarios from the domains; the same for a seed."""
    ids = spark.range(n)
    unit = lambda k: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(1 << 30)) / float(1 << 30)
    five = lambda k, lo, hi: F.array(*(unit(k + j) * (hi - lo) + lo for j in range(5)))
    names = F.array(*(F.lit(c) for c in COUNTRIES))
    return ids.select(
        F.col("id").cast("int").alias("ord"), F.concat(F.lit("random:"), "id").alias("scenario_id"), F.lit("random").alias("grp"), F.lit("random").alias("axis"), F.col("id").cast("string").alias("point"),
        F.get(names, F.floor(unit(1) * 3).cast("int")).alias("country_name"), five(10, -10.0, 15.0).alias("growth"), five(20, 0.0, 20.0).alias("interest"), five(30, -15.0, 15.0).alias("balance"),
        (F.floor(unit(2) * 5) + 1).cast("double").alias("shock_year"), (F.floor(unit(3) * 3) + 1).cast("double").alias("shock_type"), F.array(*(unit(40 + j) * 60 - 30 for j in range(3))).alias("shock_table"), F.lit(False).alias("expects_error_values"),
    )


def cell_writes(scenarios: DataFrame) -> DataFrame:
    """``(scenario_id, address, value)``: the input cells that a scenario sets."""
    strip = lambda c, start, row: F.transform(F.col(c), lambda x, k: F.struct(F.concat(F.lit("Inputs!"), F.char((k + start).cast("int")), F.lit(str(row))).alias("address"), x.cast("string").alias("value")))
    one = lambda a, c: F.array(F.struct(F.lit(a).alias("address"), F.col(c).cast("string").alias("value")))
    writes = F.concat(one("Inputs!B5", "country_name"), strip("growth", 67, 16), strip("interest", 67, 17), strip("balance", 67, 18), one("Inputs!B21", "shock_year"), one("Inputs!B22", "shock_type"), strip("shock_table", 66, 26))
    return scenarios.select("scenario_id", F.explode(writes).alias("x")).select("scenario_id", "x.*")
