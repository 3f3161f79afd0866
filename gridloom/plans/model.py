"""The debt model: all scenarios of a table evaluated in one projection.

``debt(t) = debt(t-1) (1 + r(t) / 100) / (1 + g(t) / 100) - pb(t)``, once with the inputs and once
with one of the three shifted from the shock year on.  A scenario is a row, a series an array, a
formula an expression; nothing is shuffled, so the work is spread as the rows are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values
from .scenarios import COUNTRIES

PERIODS = 5
OUTPUTS = ("baseline", "shocked", "delta")


def _path(start: str, interest: str, growth: str, balance: str, error: Column) -> Column:
    """States after each period, as values.  A step is written with plain numbers and one error, each
    named once: expressions of whole values would repeat their parts at every level."""
    strips = F.arrays_zip(F.col(interest).alias("r"), F.col(growth).alias("g"), F.col(balance).alias("p"))
    first = F.array(F.struct(F.col(f"{start}.num").alias("num"), F.coalesce(F.col(f"{start}.err"), error).alias("err")))

    def fold(acc: Column, z: Column) -> Column:
        last = F.element_at(acc, -1)
        over = F.try_divide(last["num"] * (1 + z["r"] / 100), 1 + z["g"] / 100)
        return F.concat(acc, F.array(F.struct((over - z["p"]).alias("num"), F.coalesce(last["err"], F.when(1 + z["g"] / 100 == 0, "#DIV/0!")).alias("err"))))

    states = F.slice(F.aggregate(strips, first, fold), 2, PERIODS)
    return F.transform(states, lambda v: F.struct(F.when(v["err"].isNull(), v["num"]).alias("num"), v["err"].alias("err")))


def evaluate(scenarios: DataFrame, countries: dict[str, float] | None = None) -> DataFrame:
    """``scenarios`` with every series of the model: inputs resolved, shocked inputs, three outputs.

    Outputs are arrays of ``struct<num, err>``.  Unknown countries are ``#N/A``, a shock type
    outside 1 to 3 is ``#VALUE!``, growth of -100 is ``#DIV/0!`` from its period on, blanks are zero.
    """
    countries = countries or COUNTRIES
    names, debts = F.array(*(F.lit(c) for c in countries)), F.array(*(F.lit(float(d)) for d in countries.values()))
    place = values.match(F.col("country_name"), names)
    kind = F.floor(F.coalesce("shock_type", F.lit(0.0))).cast("int")
    numbers = lambda c: F.transform(F.sequence(F.lit(0), F.lit(PERIODS - 1)), lambda k: F.coalesce(F.get(F.col(c), k), F.lit(0.0)))
    found = scenarios.withColumns({
        "initial_debt": values.index(debts, place),
        "shock_magnitude": F.coalesce(F.get(F.col("shock_table"), kind - 1), F.lit(0.0)),
        "shock_active": F.transform(F.sequence(F.lit(1), F.lit(PERIODS)), lambda t: F.when(t >= F.coalesce(F.col("shock_year"), F.lit(0.0)), 1.0).otherwise(0.0)),
        "g0": numbers("growth"), "r0": numbers("interest"), "p0": numbers("balance"),
    })
    shifted = lambda base, k: F.zip_with(base, "shock_active", lambda v, on: v + F.when(kind == k, F.col("shock_magnitude")).otherwise(0.0) * on)
    found = found.withColumns({"g1": shifted("g0", 1), "r1": shifted("r0", 2), "p1": shifted("p0", 3)})
    found = found.withColumns({"baseline": _path("initial_debt", "r0", "g0", "p0", F.lit(None).cast("string")), "shocked": _path("initial_debt", "r1", "g1", "p1", F.when(~kind.between(1, 3), "#VALUE!"))})
    gap = lambda s, b: F.struct((s["num"] - b["num"]).alias("num"), F.coalesce(s["err"], b["err"]).alias("err"))
    return found.withColumn("delta", F.zip_with("shocked", "baseline", gap))


def long(evaluated: DataFrame) -> DataFrame:
    """``(scenario_id, axis, point, cell, value)``: a row for each output cell."""
    one = lambda o: F.transform(F.col(o), lambda v, k: F.struct(F.concat(F.lit(f"output_{o}["), (k + 1).cast("string"), F.lit("]")).alias("cell"), v.alias("value")))
    cells = F.concat(*(one(o) for o in OUTPUTS))
    return evaluated.select("scenario_id", "axis", "point", F.explode(cells).alias("x")).select("scenario_id", "axis", "point", "x.*")


def flat(evaluated: DataFrame) -> DataFrame:
    """``(scenario_id, json)``: all outputs as one JSON object, keys sorted, numbers as JSON numbers, errors as texts.

    Whole numbers have no fraction.  JSON has no NaN and no infinity: such a number is an error.
    """
    odd = lambda x: F.isnan(x) | (F.abs(x) == float("inf"))
    number = lambda x: F.when(odd(x), F.raise_error(F.lit("a number is not finite"))).otherwise(values.coerced(x))
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    entry = lambda o: F.transform(F.col(o), lambda v, k: F.concat(quoted(F.concat(F.lit(f"output_{o}["), (k + 1).cast("string"), F.lit("]"))), F.lit(":"), F.coalesce(quoted(v["err"]), number(v["num"]), F.lit("null"))))
    return evaluated.select("scenario_id", F.concat(F.lit("{"), F.array_join(F.array_sort(F.concat(*(entry(o) for o in OUTPUTS))), ","), F.lit("}")).alias("json"))


def given(body, schema: str):
    """Fields of a JSON request; null where it has none or is no JSON."""
    return F.from_json(body, schema)


def sheet_cells() -> dict[str, object]:
    """The model as cells of a workbook: formulas as texts, inputs at their defaults."""
    from .scenarios import BALANCE, GROWTH, INTEREST, MAGNITUDES, SHOCK_TYPE, SHOCK_YEAR

    cells: dict[str, object] = {"Inputs!B5": next(iter(COUNTRIES)), "Inputs!B6": "=INDEX($A$10:$C$12,MATCH($B$5,$A$10:$A$12,0),2)", "Inputs!B21": SHOCK_YEAR, "Inputs!B22": SHOCK_TYPE}
    for k, (name, debt) in enumerate(COUNTRIES.items(), 10):
        cells |= {f"Inputs!A{k}": name, f"Inputs!B{k}": debt}
    cells |= {f"Inputs!{c}26": m for c, m in zip("BCD", MAGNITUDES, strict=True)}
    cells |= {"Engine!B6": "=Inputs!B6", "Engine!B20": "=Inputs!B6", "Engine!B9": "=OFFSET(Inputs!$B$26,0,Inputs!$B$22-1)"}
    for k, c in enumerate("CDEFG"):
        before, out = chr(ord(c) - 1), chr(ord(c) - 1)
        cells |= {f"Inputs!{c}16": GROWTH[k], f"Inputs!{c}17": INTEREST[k], f"Inputs!{c}18": BALANCE[k], f"Engine!{c}5": k + 1}
        cells[f"Engine!{c}6"] = f"={before}6*(1+Inputs!{c}17/100)/(1+Inputs!{c}16/100)-Inputs!{c}18"
        cells[f"Engine!{c}10"] = f"=IF({c}5>=Inputs!$B$21,1,0)"
        for row, source, options in ((14, 16, "$B$9,0,0"), (15, 17, "0,$B$9,0"), (16, 18, "0,0,$B$9")):
            cells[f"Engine!{c}{row}"] = f"=Inputs!{c}{source}+CHOOSE(Inputs!$B$22,{options})*{c}10"
        cells[f"Engine!{c}20"] = f"={before}20*(1+{c}15/100)/(1+{c}14/100)-{c}16"
        cells |= {f"Outputs!{out}12": f"=Engine!{c}6", f"Outputs!{out}13": f"=Engine!{c}20", f"Outputs!{out}14": f"={out}13-{out}12"}
    return cells


TARGETS = tuple(f"Outputs!{c}{row}" for row in (12, 13, 14) for c in "BCDEF")


def bootstrap(spark) -> dict[str, object]:
    """What a viewer starts from: axes, defaults, nodes, edges and the values of the defaults."""
    from ..operators import formula
    from .scenarios import PARAMETERS, SHOCKS, defaults

    of = formula.book(sheet_cells(), domains={"Inputs!B22": [1, 2, 3]})
    nodes, edges = formula.graph(of, TARGETS)
    start = defaults(spark)
    row = flat(evaluate(start)).first()
    given = start.drop("scenario_id", "grp", "axis", "point", "expects_error_values").first().asDict()
    return {
        "axes": {"TIME_PERIOD": list(range(1, PERIODS + 1)), "COUNTRY": list(COUNTRIES), "SHOCK_PARAMETER": list(PARAMETERS), "SHOCK": list(SHOCKS)},
        "defaults": given, "nodes": [formula.address(n) for n in nodes], "edges": [[formula.address(p), formula.address(c)] for p, c, _ in edges], "values": row["json"],
    }


def by_year(given: Column) -> Column:
    """A map by year, whose keys came as texts, by whole numbers; a key that is none is an error."""
    return F.map_from_entries(F.transform(F.map_entries(given), lambda e: F.struct(e["key"].cast("int"), e["value"])))


def normalised(requests: DataFrame, default: dict[str, str]) -> DataFrame:
    """``(id, inputs, unknown)`` of JSON requests: defaults filled in, ids that no default has listed."""
    given = F.coalesce(F.from_json("body", "map<string,string>"), F.create_map().cast("map<string,string>"))
    base = F.create_map(*(F.lit(x) for kv in sorted(default.items()) for x in kv))
    known = F.array(*(F.lit(k) for k in default))
    kept = F.map_filter(given, lambda k, v: F.array_contains(known, k))
    merged = F.map_from_entries(F.array_sort(F.map_entries(F.map_zip_with(base, kept, lambda k, b, o: F.coalesce(o, b)))))
    return requests.select("id", merged.alias("inputs"), F.array_sort(F.array_except(F.map_keys(given), known)).alias("unknown"))
