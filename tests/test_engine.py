import json
import math
import zipfile

import pytest
from pyspark.sql import functions as F

from gridloom.functions import address, values
from gridloom.operators import audit, bindings, graph, lookups, parity, recurrence
from gridloom.plans import cache, model, scenarios
from gridloom.sources import bindings as shards
from gridloom.sources import workbook
from gridloom.streaming import live

# The published outputs of the default inputs.
BASELINE = [61.28985507246378, 62.0859413288525, 62.38587341256677, 62.18725444354536, 61.487675962596306]
SHOCKED = [61.28985507246378, 63.29945741415009, 64.85855735045921, 65.9560587630321, 66.58059223010186]


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()


def test_default_outputs(spark):
    row = model.evaluate(scenarios.defaults(spark)).first()
    assert [v["num"] for v in row["baseline"]] == pytest.approx(BASELINE, abs=1e-9)
    assert [v["num"] for v in row["shocked"]] == pytest.approx(SHOCKED, abs=1e-9)
    assert row["delta"][0]["num"] == 0


def test_sweep_and_errors(spark):
    sweep = scenarios.sweep(spark)
    sizes = {r["grp"]: r["count"] for r in sweep.groupBy("grp").count().collect()}
    assert (sizes["canonical"], sizes["single_axis"], sizes["combo"]) == (12, 61, 45)
    found = {r["scenario_id"]: r for r in model.evaluate(sweep.where("grp = 'error'")).collect()}
    errs = lambda name, out="shocked": [v["err"] for v in found[f"error:{name}"][out]]
    assert errs("unknown_country", "baseline") == errs("trailing_space") == ["#N/A"] * 5
    assert errs("shock_type_0") == errs("shock_type_4", "delta") == ["#VALUE!"] * 5 and errs("shock_type_4", "baseline") == [None] * 5
    assert errs("growth_minus_100", "baseline") == [None, None, "#DIV/0!", "#DIV/0!", "#DIV/0!"]
    assert errs("shock_year_2.5") == [None] * 5 and math.isnan(found["error:nan"]["baseline"][4]["num"])
    assert [v["num"] for v in found["error:shock_year_6"]["delta"]] == [0.0] * 5
    assert scenarios.draws(spark).collect() == scenarios.draws(spark).collect()
    assert scenarios.cell_writes(scenarios.defaults(spark)).count() == 21


NAN, INF = float("nan"), float("inf")
LADDER = [
    (None, None, True), (None, 1.0, False), (1.0, None, False), (NAN, NAN, True), (INF, INF, True), (-INF, INF, False), (1.0000001, 1.0, True), (1.01, 1.0, False),
    (1e16, 1e16 + 2, True), (1e15, 1e15 + 1000, True), (0.0, 1e-5, False), (-1e16, -(1e16 + 2), True), ("#VALUE!", "#VALUE!", True), ("#DIV/0!", "#N/A", False), ("a", "a", True), ("a", "A", False), (True, True, True), (True, False, False), (NAN, 1.0, False),
]


def _value(x):
    if x is None:
        return values.value()
    if isinstance(x, bool):
        return values.value(flag=x)
    return values.value(x) if isinstance(x, float) else values.value(text=x)


@pytest.mark.parametrize(("golden", "sut", "passed"), LADDER)
def test_ladder(spark, golden, sut, passed):
    v = one(spark, v=parity.verdict(_value(golden), _value(sut)))["v"]
    assert v["passed"] is passed
    if golden == 0.0:
        assert v["rel_diff"] == INF
    if golden == 1e15:
        assert v["rel_diff"] == 1e-12
    assert v["matched_error"] == (passed and (golden == "#VALUE!" or golden != golden))


def test_report(spark):
    rows = spark.createDataFrame([("a", "x", k, k % 3 != 0, False, float(k)) for k in range(9)], "axis string, point string, orderkey long, passed boolean, matched_error boolean, abs_diff double")
    text = parity.report(rows, "title", ["axis", "orderkey"])
    assert parity.parse_report(text)["passed"] == "6/9 (66.67%)" and "first divergence: a 0" in text
    assert parity.exit_code(rows.withColumn("flagged_matched_error", F.lit(False))) == 1
    with pytest.raises(ValueError):
        parity.parse_report("nothing")


def test_formula_functions(spark):
    v = values.value
    keys = F.array(F.lit("b"), F.lit("a"), F.lit("a"))
    row = one(
        spark,
        m=values.match(F.lit("a"), keys), miss=values.match(F.lit("z"), keys), i=values.index(F.array(F.lit(1.0), F.lit(2.0)), v(3.0)), o=values.offset(F.array(F.lit(1.0)), v(1.0)),
        d=values.div(v(1.0), v()), e=values.add(v(err=F.lit("#N/A")), v(1.0)), t=values.add(v(text=F.lit("x")), v(1.0)), b=values.add(v(), v(2.0)), q=values.equal(v(text=F.lit("Ab")), v(text=F.lit("aB"))),
        c=values.choose(v(2.9), v(1.0), v(2.0)), x=values.choose(v(0.0), v(1.0)), n=values.net_present_value(F.lit(0.1), F.array(F.lit(110.0), F.lit(121.0))), k=values.typed(F.lit(" #REF! ")), s=values.typed(F.lit("2.5")),
    )
    assert (row["m"]["num"], row["miss"]["err"], row["i"]["err"], row["o"]["num"]) == (2.0, "#N/A", "#REF!", None)
    assert (row["d"]["err"], row["e"]["err"], row["t"]["err"], row["b"]["num"], row["q"]["bool"]) == ("#DIV/0!", "#N/A", "#VALUE!", 2.0, True)
    assert (row["c"]["num"], row["x"]["err"], row["k"]["err"], row["s"]["num"]) == (2.0, "#VALUE!", "#REF!", 2.5) and row["n"] == pytest.approx(200.0)


def test_addresses(spark):
    cols = spark.range(1, 18279).select("id", address.column_letters(F.col("id")).alias("l")).select("id", "l", address.column_number(F.col("l")).alias("n"))
    assert cols.where("id <> n OR n IS NULL").count() == 0 and cols.where("l = 'ZZZ'").first()["id"] == 18278 and cols.where("l = 'AAA'").first()["id"] == 703
    row = one(spark, a=address.normalised(F.lit("'Discrete Risks'!$h2")), b=address.normalised(F.lit("a$1")), c=address.parsed(F.lit("1A")), h=address.header(F.lit("Growth (pp)"), "strip_trailing_unit"), t=address.truncated(F.lit("abcdef"), 5), f=address.function_names(F.lit("=INDEX(Z1,MATCH(A1,B1,0))+EXP(C1)")))
    assert (row["a"], row["b"], row["c"], row["h"], row["t"]["text"], row["f"]) == ("'Discrete Risks'!H2", "Workbook!A1", None, "Growth", "ab...", ["INDEX", "MATCH", "EXP"])


def test_spans_and_rectangles(spark):
    cells = spark.createDataFrame([(1, c) for c in (2, 3, 4, 7, 8)], "row int, col int")
    assert sorted(tuple(r) for r in bindings.spans(cells).select("c1", "c2").collect()) == [(2, 4), (7, 8)]
    rect = lambda cs: sorted(r["range"] for r in bindings.rectangles(spark.createDataFrame(cs, "row int, col int")).collect())
    assert rect([(2, 2), (2, 3), (3, 2), (3, 3)]) == ["B2:C3"] and rect([(2, 2), (2, 4), (3, 2), (3, 4)]) == ["B2:B3", "D2:D3"]


def test_graph_summary_and_order_in_layers(spark):
    import random

    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "node string")
    edges = spark.createDataFrame([("a", "b", ["x"]), ("a", "c", None), ("b", "c", [])], "parent string, child string, causes array<string>")
    assert tuple(graph.summary(nodes, edges).first()) == (3, 3, 1, 1)
    assert tuple(graph.summary(nodes.limit(0), edges.limit(0)).first()) == (0, 0, 0, 0)
    r = random.Random(8)
    placed = [(f"n{k}", k % 3, k) for k in range(12)]
    pairs = sorted({(a, b) for a, la, _ in placed for b, lb, _ in placed if la < lb and r.random() < 0.3})
    columns = [[n for n, layer, _ in placed if layer == k] for k in range(3)]
    for _ in range(2):
        for k, side in [(1, 1), (2, 1), (1, 0), (0, 0)]:
            at = {n: i for c in columns for i, n in enumerate(c)}
            near = {n: [p[1 - side] for p in pairs if p[side] == n] for n in columns[k]}
            columns[k].sort(key=lambda n, at=at, near=near: sum(at[x] for x in near[n]) / len(near[n]) if near[n] else at[n])
    frame = spark.createDataFrame(placed, "node string, layer int, position int")
    found = graph.within_layers(frame, spark.createDataFrame(pairs, "source string, target string"))
    assert {(x["node"], x["layer"], x["rank"]) for x in found.collect()} == {(n, k, i) for k, c in enumerate(columns) for i, n in enumerate(c)}
    assert graph.within_layers(frame.limit(0), spark.createDataFrame(pairs, "source string, target string")).count() == 0


def test_graph_cycles_and_depth(spark):
    chain = spark.createDataFrame([(f"n{k + 1}", f"n{k}") for k in range(12)], "parent string, child string")
    nodes = spark.createDataFrame([(f"n{k}",) for k in range(13)], "node string")
    assert {r["node"]: r["layer"] for r in graph.layers(nodes, chain).collect()} == {f"n{k}": k for k in range(13)}
    ring = chain.unionByName(spark.createDataFrame([("n0", "n12")], "parent string, child string"))
    assert graph.layers(nodes, ring) is None and graph.closure(ring, nodes.where("node = 'n5'")).count() == 13
    refs = spark.createDataFrame([("p", "Inputs", 26, 2, "k"), ("q", "Inputs", 1, 1, "none")], "parent string, sheet string, row int, col int, control string")
    found = graph.dynamic_edges(refs, spark.createDataFrame([("k", 0), ("k", 1), ("k", 2)], "control string, step int")).collect()
    assert len(found) == 4 and sum(r["child"] is None for r in found) == 1


def test_blocked_path_equals_fold(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("k"), "id", (F.col("id") % 7).cast("double").alias("r"), (F.col("id") % 5).cast("double").alias("g"), F.lit(0.01).alias("p"), F.lit(50.0).alias("d"))
    got = {(r["k"], r["n"]): r["state"] for r in recurrence.blocked_path(rows, "k", ["id"], "r", "g", "p", F.col("d"), block=16).collect()}
    fold = recurrence.series(rows, "k", ["id"], *(F.col(c) for c in "rgp")).select("k", recurrence.path(F.lit(50.0), F.col("s")).alias("a")).collect()
    assert all(got[(r["k"], n + 1)] == pytest.approx(x, rel=1e-9) for r in fold for n, x in enumerate(r["a"])) and len(got) == 500


def test_long_paths_come_in_pieces(spark):
    """Series around the length of a piece, with a null that lasts, an empty and a null one."""
    lengths = [0, 1, 63, 64, 65, 128, 300]
    lists = [(n, [(float(k % 7), -100.0 if k == 290 else float(k % 5), 0.25) for k in range(n)]) for n in lengths] + [(-1, None)]
    rows = spark.createDataFrame(lists, f"n int, s array<{recurrence.STEP}>")
    for r in rows.select("n", "s", recurrence.path(F.lit(50.0), F.col("s")).alias("a")).collect():
        want, now = [], 50.0
        for r_, g, p in r["s"] or []:
            now = None if now is None or g == -100 else now * (1 + r_ / 100) / (1 + g / 100) - p
            want.append(now)
        assert r["a"] == (None if r["s"] is None else want)


def test_blocked_path_of_one_key_in_many_partitions(spark):
    rows = spark.range(3000).select(F.lit(None).cast("string").alias("k"), "id", (F.col("id") % 7).alias("r"), (F.col("id") % 5).alias("g"), F.lit(0.01).alias("p")).repartition(7)
    rows = rows.withColumn("k", F.when(F.col("id") % 10 == 0, "few"))
    got = {(r["k"], r["n"]): r["state"] for r in recurrence.blocked_path(rows, "k", ["id"], "r", "g", "p", F.lit(50.0), block=8).collect()}
    assert len(got) == 3000
    for key, ids in (("few", range(0, 3000, 10)), (None, [i for i in range(3000) if i % 10])):
        now = 50.0
        for n, i in enumerate(ids, 1):
            now = now * (1 + i % 7 / 100) / (1 + i % 5 / 100) - 0.01
            assert got[key, n] == pytest.approx(now, rel=1e-9)
    assert recurrence.blocked_path(rows.limit(0), "k", ["id"], "r", "g", "p", F.lit(50.0)).count() == 0


def test_absent_inputs_in_the_report(spark):
    writes = spark.createDataFrame([("a", "S!A1"), ("b", "S!A1"), ("a", "S!A2"), ("a", None)], "scenario_id string, address string")
    absent = parity.absent_inputs(writes.where("address IS NOT NULL"), spark.createDataFrame([("S!A2",)], "node string"))
    rows = spark.createDataFrame([("a", "x", 1, True, False, 0.0)], "axis string, point string, k long, passed boolean, matched_error boolean, abs_diff double")
    assert "ABSENT INPUTS\nS!A1: 2 scenarios\n" in parity.report(rows, "t", ["k"], absent)
    assert "ABSENT INPUTS\nnone\n" in parity.report(rows, "t", ["k"], absent.limit(0))


def test_domains_and_bindings(spark):
    w = lambda kind, lo, hi, vals, num, text: bindings.within(F.lit(kind), F.lit(lo).cast("double"), F.lit(hi).cast("double"), vals, F.lit(num).cast("double"), F.lit(text).cast("string"))
    none = F.lit(None).cast("array<string>")
    row = one(spark, a=w("between", 1.0, 5.0, none, 2.5, None), b=w("between", 1.0, 5.0, none, 5.0, None), c=w("real_between", 0.0, None, none, 9.9, None), d=w("enum", None, None, F.array(F.lit("x")), None, "y"))
    assert (row["a"], row["b"], row["c"], row["d"]) == (False, True, True, False)
    series = spark.createDataFrame([("s", "In", "input", ["B2:D2"]), ("e", "In", "output", [])], "series_id string, sheet string, direction string, data_ranges array<string>")
    bound = bindings.bound_cells(series)
    dims = spark.createDataFrame([("s", "T", "column_header", 1, None, None, "strip", False)], "series_id string, dim_id string, bind_kind string, header_row int, label_column string, value string, normalize string, fill boolean")
    cells = spark.createDataFrame([("In", 1, 2, 2020.0, None), ("In", 1, 4, None, " x ")], "sheet string, row int, col int, num double, str string")
    keys = bindings.resolve_keys(bound, dims, cells)
    assert {r["col"]: r["key"] for r in keys.collect()} == {2: "2020", 3: None, 4: "x"}
    loose = spark.createDataFrame([("In", 9, 9)], "sheet string, row int, col int")
    found = bindings.audit(series, keys, bound, dims, loose)
    assert sorted(r["code"] for r in found.collect()) == ["empty_public_series", "partial_bind_failure", "sparse_label_without_fill", "unbound_graph_cell"]
    assert tuple(bindings.summary(found).first()) == (3, 1, False)
    assert {r["key"] for r in bindings.resolve_keys(bound, dims.withColumn("fill", F.lit(True)), cells).collect()} == {"2020", "x"}
    with pytest.raises(ValueError):
        bindings.gate(loose)
    assert bindings.gate(loose, "warn") and bindings.gate(loose, "off") is None


def test_shards(spark, tmp_path):
    (tmp_path / "a.bindings.yaml").write_text("series:\n- id: g\n  sheet: In\n  data_range: C16:G16\n  layout: row_series\n  direction: input\n  domain: {real_between: [-10, 15]}\n  measure: {dtype: float}\n  key: [TIME]\n  dimensions:\n  - {id: TIME, concept: TIME, scope: cell, bind: {kind: column_header, header_row: 15}}\n")
    found = shards.load(spark, str(tmp_path))
    assert found["series"].first()["data_ranges"] == ["C16:G16"] and found["dims"].first()["header_row"] == 15 and found["domains"].first()["hi"] == 15.0
    assert shards.load(spark, str(tmp_path / "none"))["series"].count() == 0


def test_workbook(spark, tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="In" sheetId="1" r:id="r1"/></sheets><definedNames><definedName name="zone">In!$A$1:$B$2</definedName><definedName name="gone">In!#REF!</definedName></definedNames></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>name</t></si></sst>")
        z.writestr("xl/worksheets/s.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1"><v>10</v></c><c r="B1" t="s"><v>0</v></c><c r="C1" t="e"><v>#N/A</v></c><c r="D1"><f>$A$1+A1+SUM(A1:A2)</f><v>12</v></c></row><row r="2"><c r="A2" t="b"><v>1</v></c><c r="B2"/><c r="E2"><f t="shared" ref="E2:E3" si="0">A1*$A$1</f><v>1</v></c></row><row r="3"><c r="E3"><f t="shared" si="0"/><v>2</v></c></row></sheetData></worksheet>')
        z.writestr("xl/calcChain.xml", "<calcChain/>")
    path = str(tmp_path / "*.xlsx")
    cells = {r["address"]: r for r in workbook.cells(spark, path).collect()}
    assert [cells[f"In!{a}"]["kind"] for a in ("A1", "B1", "C1", "D1", "A2", "B2")] == ["value", "value", "error", "formula", "value", "blank"]
    assert cells["In!B1"]["str"] == "name" and cells["In!A2"]["bool"] is True and cells["In!E3"]["formula"] == "=A2*$A$1"
    edges = {(r["parent"], r["child"]) for r in workbook.edges(workbook.cells(spark, path)).collect()}
    assert edges == {("In!D1", "In!A1"), ("In!D1", "In!A2"), ("In!E2", "In!A1"), ("In!E3", "In!A1"), ("In!E3", "In!A2")}
    names = {r["name"]: r for r in workbook.named_ranges(spark, path).collect()}
    assert (names["zone"]["r2"], names["zone"]["c2"], names["gone"]["broken"]) == (2, 2, True)
    assert workbook.parts(spark, path).first()["kind"] == "calc_chain" and workbook.sheets(spark, path).first()["sheet_type"] == "worksheet"
    assert audit.totals(workbook.cells(spark, path)).first()["n_formula"] == 3


def test_cache_and_manifest(spark, tmp_path):
    store, calls = cache.Cache(spark, str(tmp_path / "c")), []
    build = lambda: calls.append(1) or spark.range(3)
    digest = cache.key(targets=sorted(["b", "a"]))
    assert digest == cache.key(targets=["a", "b"]) != cache.key(targets=["a"])
    assert store.get_or_build(digest, build).count() == store.get_or_build(digest, build).count() == 3 and len(calls) == 1
    assert store.get_or_build(digest, build, rebuild=True).count() == 3 and len(calls) == 2
    assert store.newest().count() == 3 and store.prune(set()) == [digest] and store.newest() is None
    path = str(tmp_path / "m")
    cache.record(spark, path, "extract", {"workbook": "1", "old": "x"})
    now = spark.createDataFrame([("workbook", "2"), ("new", "y")], "label string, fingerprint string")
    assert [tuple(r) for r in cache.drift(cache.manifest(spark, path), now).collect()] == [("new", "unchecked"), ("old", "missing"), ("workbook", "changed")]
    with pytest.raises(ValueError):
        cache.require(spark, path, "export")
    assert cache.gathered([lambda: 1, lambda: 1 / 0], collect_errors=True)[0] == 1


def test_cache_rebuilds_an_entry_of_another_shape(spark, tmp_path):
    store = cache.Cache(spark, str(tmp_path / "c"))
    now = spark.range(2).withColumn("x", F.lit("a"))
    store.get_or_build("d", lambda: spark.range(3))
    assert store.get_or_build("d", lambda: now, shape=now.schema).columns == ["id", "x"]
    assert store.get_or_build("d", lambda: 1 / 0, shape=now.schema).count() == 2


def test_lookups(spark):
    base = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    over = spark.createDataFrame([("a", None), ("z", 3.0)], "k string, v double")
    assert {r["k"]: r["v"] for r in lookups.overlay(base, over, ["k"], "v").collect()} == {"a": None, "b": 2.0}
    assert [r["k"] for r in lookups.unknown(over, base, ["k"]).collect()] == ["z"]


def test_requests(spark):
    rows = spark.createDataFrame([(1, '{"b":"9","x":"1"}'), (2, None)], "id int, body string")
    got = {r["id"]: r for r in model.normalised(rows, {"a": "1", "b": "2"}).collect()}
    assert got[1]["inputs"] == {"a": "1", "b": "9"} and got[1]["unknown"] == ["x"] and got[2]["inputs"] == {"a": "1", "b": "2"}
    flat = json.loads(model.flat(model.evaluate(scenarios.defaults(spark))).first()["json"])
    assert flat["output_baseline[1]"] == 61.28985507246378 and len(flat) == 15
    odd = model.flat(model.evaluate(scenarios.sweep(spark).where("point = 'unknown_country'"))).first()["json"]
    assert json.loads(odd)["output_delta[5]"] == "#N/A"
    with pytest.raises(Exception, match="not finite"):
        model.flat(model.evaluate(scenarios.sweep(spark).where("point = 'nan'"))).collect()


def streamed(spark, out, mode, name):
    query = out.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted(map(str, spark.table(name).collect()))


def test_streams_equal_batches(spark, tmp_path):
    sweep, path = scenarios.sweep(spark), str(tmp_path / "scenarios")
    sweep.write.parquet(path)
    batch = live.evaluated(spark.read.schema(sweep.schema).parquet(path))
    stream = live.evaluated(spark.readStream.schema(sweep.schema).parquet(path))
    assert streamed(spark, stream, "append", "scenario_cells") == sorted(map(str, batch.collect())) != []

    path = str(tmp_path / "edits")
    rows = [("2024-01-01 10:05:00", "set"), ("2024-01-01 10:55:00", "set"), ("2024-01-01 11:00:00", "clear"), (None, "set"), ("2024-01-01 11:59:59", None)]
    edits = spark.createDataFrame(rows, "ts string, event_type string").withColumn("ts", F.col("ts").cast("timestamp"))
    edits.write.parquet(path)
    batch = live.edits(spark.read.schema(edits.schema).parquet(path)).collect()
    stream = live.edits(spark.readStream.schema(edits.schema).parquet(path))
    assert streamed(spark, stream, "complete", "edit_counts") == sorted(map(str, batch))
    assert sorted((str(r.start), str(r.event_type), r.n) for r in batch) == [("2024-01-01 10:00:00", "set", 2), ("2024-01-01 11:00:00", "None", 1), ("2024-01-01 11:00:00", "clear", 1)]
