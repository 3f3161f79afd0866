"""Formulas: parsing, dependencies, evaluation; series accessors, reports and caches."""

import math

import pytest
from pyspark.sql import functions as F

from gridloom.functions import address, values
from gridloom.operators import audit, formula, graph, parity, series
from gridloom.plans import cache, model, scenarios


def run(spark, cells, targets, writes=(), **more):
    rows = spark.createDataFrame([("s", a, v) for a, v in writes] or [("s", "Z!Z99", None)], "scenario_id string, address string, value string")
    found = formula.evaluate(formula.book(cells, **more), rows, targets).collect()
    plain = lambda v: v["err"] or (v["num"] if v["num"] is not None else v["bool"] if v["bool"] is not None else v["str"])
    return {r["address"]: plain(r["value"]) for r in found}


def test_precedence_and_functions(spark):
    texts = ["=1+2*3^2", "=-2^2", "=(1+2)*3-4/8", "=50%+1", '="a"&1&TRUE', "=1<>2", "=2>=3", "=IF(1>2,#N/A,7)", "=IFERROR(1/0,9)", "=SUM(1,2,MAX(3,4))", "=MIN(A1:A3)", "=AND(TRUE,1)", "=NOT(0)", "=ISBLANK(B9)", "=CHOOSE(2,1/0,5)", "=CHOOSE(9,1)", "=MATCH(\"B\",C1:C3,0)", "=MATCH(5,A1:A3,0)", "=INDEX(A1:A3,2)", "=INDEX(A1:C3,3,1)", "=INDEX(A1:A3,4)", "=NOSUCH(1)", "=nobody", "=1/0+1", '="x"+1', "=ABS(-3)", "=ROUND(2.345,1)", "=SUM(A:A)", "=SUM(1:1)", "=_xlfn.MAX(1,2)"]
    want = [19.0, 4.0, 8.5, 1.5, "a1TRUE", True, False, 7.0, 9.0, 7.0, 10.0, True, True, True, 5.0, "#VALUE!", 2.0, "#N/A", 20.0, 30.0, "#REF!", "#NAME?", "#NAME?", "#DIV/0!", "#VALUE!", 3.0, 2.3, 60.0, 10.0, 2.0]
    cells = {"S!A1": 10, "S!A2": 20, "S!A3": 30, "S!C1": "a", "S!C2": "b", "S!C3": "c"} | {f"S!F{k}": t for k, t in enumerate(texts, 101)}
    places = [f"S!F{k}" for k in range(101, 101 + len(texts))]
    got = run(spark, cells, places)
    assert [(texts[k], got[a]) for k, a in enumerate(places)] == list(zip(texts, want, strict=True))


def test_writes_names_and_dynamic_references(spark):
    cells = {"'My Sheet'!A1": 1, "'My Sheet'!B1": 2, "'My Sheet'!C1": 3, "'My Sheet'!A2": "=OFFSET(start,0,$B$9)*rate", "'My Sheet'!A3": "='My Sheet'!A2+1", "'My Sheet'!B9": 2}
    names = {"start": "'My Sheet'!$A$1", "rate": "'My Sheet'!$B$1"}
    targets = ["'My Sheet'!A3"]
    assert run(spark, cells, targets, names=names) == {"'My Sheet'!A3": 7.0}
    assert run(spark, cells, targets, [("'My Sheet'!$B$9", "1"), ("'my sheet'!C1", "5")], names=names) == {"'My Sheet'!A3": 5.0}
    assert run(spark, cells, targets, [("'My Sheet'!A2", "#N/A")], names=names) == {"'My Sheet'!A3": "#N/A"}
    of = formula.book(cells, names=names, domains={"'My Sheet'!B9": [0, 2]})
    read = formula.reads(of.formulas[("My Sheet", 2, 1)], of)
    assert {c[1:]: sorted(x) for c, x in read.items()} == {(9, 2): [], (1, 1): ["dynamic_offset"], (1, 3): ["dynamic_offset"], (1, 2): []}


def test_formulas_that_cannot_be_read():
    for text in ("=1+", "=(1", "=SUM(1 2)", "=1 2", "=\"a"):
        with pytest.raises(ValueError):
            formula.parse(text)
    with pytest.raises(ValueError, match="depends on itself"):
        formula.graph(formula.book({"S!A1": "=B1", "S!B1": "=A1"}), ["S!A1"])


def test_graph_of_the_model():
    of = formula.book(model.sheet_cells(), domains={"Inputs!B22": [1, 2, 3]})
    nodes, edges = formula.graph(of, model.TARGETS)
    assert (len(nodes), len(edges)) == (81, 143) and sum(n in of.formulas for n in nodes) == 49
    assert not {("Inputs", 10, 3), ("Inputs", 11, 3)} & set(nodes)
    place = {n: k for k, n in enumerate(nodes)}
    assert all(place[p] > place[c] for p, c, _ in edges)


def test_model_errors_from_formulas(spark):
    sweep = scenarios.sweep(spark).where("grp = 'error' AND point IN ('unknown_country', 'shock_type_4', 'growth_minus_100')")
    of = formula.book(model.sheet_cells(), domains={"Inputs!B22": [1, 2, 3]})
    got = {(r["scenario_id"], r["address"]): (r["value"]["num"], r["value"]["err"]) for r in formula.evaluate(of, scenarios.cell_writes(sweep), model.TARGETS).collect()}
    for r in model.long(model.evaluate(sweep)).collect():
        name, period = r["cell"].removeprefix("output_").rstrip("]").split("[")
        at = f"Outputs!{'ABCDEF'[int(period)]}{dict(baseline=12, shocked=13, delta=14)[name]}"
        num, err = got[r["scenario_id"], at]
        assert (err is None) == (r["value"]["err"] is None) and (num is None or math.isclose(num, r["value"]["num"]))


def test_bootstrap(spark):
    found = model.bootstrap(spark)
    assert set(found) == {"axes", "defaults", "nodes", "edges", "values"} and len(found["edges"]) == 143 and '"output_delta[5]"' in found["values"]


def test_strict_accessors_raise(spark):
    one = spark.range(1)
    held = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    for wrong, message in ((series.zipped(a=F.array(F.lit(1)), b=F.array(F.lit(1), F.lit(2))), "lengths differ"), (series.selected(held, F.lit("z")), "no value for z"), (series.ordered_values(held, F.array(F.lit("a"), F.lit("z"))), "missing keys z")):
        with pytest.raises(Exception, match=message):
            one.select(wrong).collect()
    entries = F.create_map(*(F.lit(x) for x in ("a", '"x"', "b", "[1]", "c", "null", "d", "1.5", "e", " {}")))
    row = one.select(series.plain_keys(entries).alias("k"), series.ordered_values(held, F.array(F.lit("b"), F.lit("a"))).alias("v"), series.overridden(F.array(F.lit(1), F.lit(2)), F.lit(5), F.lit(9)).alias("o")).first()
    assert row["k"] == {"a": '"x"', "d": "1.5"} and row["v"] == [2, 1] and row["o"] == [1, 2]


def test_ladder(spark):
    v = values.value
    pairs = [(v(flag=True), v(1.0), True, True), (v(flag=True), v(0.0), False, False), (values.typed(F.lit("1" * 320)), values.typed(F.lit("1" * 319 + "2")), False, False), (values.typed(F.lit("7" * 320)), values.typed(F.lit("7" * 320)), True, True), (v(), v(), True, False), (v(float("nan")), v(float("nan")), True, False), (v(text="a"), v(text="a"), True, True)]
    for golden, sut, passed, healthy in pairs:
        g, s = (spark.range(1).select(F.lit("x").alias("k"), x.alias("value")) for x in (golden, sut))
        row = parity.compare(g, s, ["k"]).first()
        assert (row["passed"], row["healthy"]) == (passed, healthy)
    rows = parity.csv_rows(parity.compare(spark.range(1).select(F.lit("x").alias("scenario_id"), v(2.0).alias("value")), spark.range(1).select(F.lit("x").alias("scenario_id"), v(err=F.lit("#N/A")).alias("value")), ["scenario_id"]))
    assert rows.columns == list(parity.CSV) and rows.first()["golden"] == "2" and rows.first()["sut"] == "#N/A"


def test_layers_of_a_cycle_and_of_unknown_ends(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    edges = lambda *e: spark.createDataFrame(list(e), "parent string, child string")
    assert graph.layers(nodes, edges(("a", "b"), ("b", "a"))) is None
    assert {r["node"]: r["layer"] for r in graph.layers(nodes, edges(("a", "b"), ("b", "c"), ("a", "c"), ("a", "b"), ("c", "elsewhere"))).collect()} == {"c": 0, "b": 1, "a": 2}


def test_labels_by_key_match_the_plain_form(spark):
    choices = ["Alpha", " Beta ", "Beta", "Gamma one", "Gamma two", "Delta long"]
    wanted = ["Alpha", "Beta", " Beta", "Gamma", "Gam one", "Delta", "alpha", "", None, "Gamma one "]
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(wanted)], "id int, w string")
    got = {r["id"]: (r["label"], r["err"]) for r in address.resolved_labels(rows, "w", spark.createDataFrame([(c,) for c in choices], "choice string")).collect()}
    plain = rows.select("id", address.resolved_label(F.col("w"), F.array(*(F.lit(c) for c in choices))).alias("x")).collect()
    assert {k: v for k, v in got.items() if wanted[k] is not None} == {r["id"]: (r["x"]["label"], r["x"]["err"]) for r in plain if wanted[r["id"]] is not None} and got[8] == (None, "unknown")


def test_audit_report(spark):
    totals = audit.totals(spark.createDataFrame([("A", "formula", "=1"), ("A", "value", None), ("B", "blank", None)], "sheet string, kind string, formula string"))
    calls = audit.function_calls(spark.createDataFrame([(1, "=SUM(1)+OFFSET(A1,1,1)")], "id int, formula string"))
    text = audit.report(totals, calls, spark.createDataFrame([("rate", 2)], "name string, n_formulas long"))
    assert "| A | 2 | 1 | 1 | 0 | 0 | 0 |" in text and "1. A: 2 cells" in text and "- OFFSET: 1 calls in 1 formulas (dynamic)" in text and "- rate: 2 formulas" in text


def test_reports_and_regeneration(spark, tmp_path):
    held = {}
    reports = cache.Reports(lambda: held.get("m"), lambda m: held.update(m=m))
    assert reports.run("k", lambda: 0) == (0, False) and reports.run("k", lambda: 1) == (0, True)
    assert reports.run("other", lambda: 1) == (1, False) and reports.run("other", lambda: 0) == (0, False)
    assert not cache.Reports(lambda: held["m"], held.update, ci=True).reusable("other")
    tables = cache.Cache(spark, str(tmp_path))
    build = lambda: spark.range(3)
    assert cache.regenerate({"a": ("k1", build), "b": ("k2", build)}, tables, {"a"}) == {"a": "built", "b": "skipped"}
    assert [k for k, _ in tables.keys()] == ["k1"]
    part = next(tmp_path.glob("k1/part-*.parquet"))
    part.write_bytes(b"broken")
    (tmp_path / "k1" / f".{part.name}.crc").unlink(missing_ok=True)
    assert tables.get_or_build("k1", build, verify=True).count() == 3
