"""More operators as queries over the driver's tables, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import address, values
from ..operators import audit, bindings, formula, graph, lookups, parity, recurrence, series
from . import model, scenarios
from .registry import _COMBO_SQL, _EDGES_SQL, _OWNED_SQL, _graph, _owned, _query, _t

_RAW_SQL = "SELECT o_orderkey AS id, o_orderpriority AS sheet, CASE o_orderkey % 5 WHEN 0 THEN '=SUM([1]A!A1)' WHEN 1 THEN '#N/A' WHEN 2 THEN '' WHEN 3 THEN '=A1+B2' ELSE o_totalprice::VARCHAR END AS raw FROM orders"


def _raw(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, "=SUM([1]A!A1)").when(k == 1, "#N/A").when(k == 2, "").when(k == 3, "=A1+B2").otherwise(F.col("o_totalprice").cast("string"))
    return _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("sheet"), text.alias("raw"))


_KIND = "CASE WHEN raw = '' THEN 'blank' WHEN raw LIKE '=%' THEN 'formula' WHEN raw = '#N/A' THEN 'error' ELSE 'value' END"


@_query(f"SELECT id, {_KIND} AS kind FROM ({_RAW_SQL})")
def cell_kinds(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", audit.kind(F.col("raw")).alias("kind"))


_TOTALS_SQL = f"SELECT sheet, count(*) AS n_cells, count(*) FILTER (kind = 'formula') AS n_formula, count(*) FILTER (kind = 'value') AS n_value, count(*) FILTER (kind = 'error') AS n_error, count(*) FILTER (kind = 'blank') AS n_blank, count(*) FILTER (raw LIKE '=%[%]%') AS n_external FROM (SELECT *, {_KIND} AS kind FROM ({_RAW_SQL})) GROUP BY sheet"


def _totals(spark, sf_dir) -> DataFrame:
    cells = _raw(spark, sf_dir).withColumn("kind", audit.kind(F.col("raw")))
    return audit.totals(cells.withColumn("formula", F.when(F.col("kind") == "formula", F.col("raw"))))


@_query(_TOTALS_SQL)
def sheet_totals(spark, sf_dir):
    return _totals(spark, sf_dir)


@_query(f"SELECT sheet, n_cells FROM ({_TOTALS_SQL}) ORDER BY n_cells DESC, sheet LIMIT 3")
def largest_sheets(spark, sf_dir):
    """The report's three largest sheets."""
    return audit.largest(_totals(spark, sf_dir)).select("sheet", "n_cells")


@_query("SELECT p_partkey AS node, CASE p_partkey % 3 WHEN 0 THEN 'constant' WHEN 1 THEN 'input' END AS kind FROM part")
def leaf_kinds(spark, sf_dir):
    k = F.col("p_partkey") % 3
    vals = F.when(k == 0, F.array("p_brand")).when(k == 1, F.array("p_brand", "p_type"))
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), bindings.leaf_kind(vals).alias("kind"))


@_query("SELECT p_brand AS grp, p_partkey AS node, 'constant' AS kind FROM part WHERE false UNION ALL SELECT 'whole', p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'constant' ELSE 'input' END FROM part")
def leaf_kinds_best_effort(spark, sf_dir):
    """All leaves have a domain in one table; in the other one lacks it, so there no leaf is classified."""
    part = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), F.when(F.col("p_partkey") % 2 == 0, F.array("p_brand")).otherwise(F.array("p_brand", "p_type")).alias("vals"))
    gap = part.withColumn("vals", F.when(F.col("node") != 7, F.col("vals")))
    named = lambda df, name: bindings.best_effort_leaf_kinds(df).select(F.lit(name).alias("grp"), "node", "kind")
    return named(part, "whole").unionByName(named(gap, "gap"))


@_query("SELECT p_partkey AS node FROM part WHERE p_partkey % 7 = 3 OR p_partkey NOT IN (SELECT l_partkey FROM lineitem)")
def undomained_leaves(spark, sf_dir):
    leaves = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"))
    domained = _t(spark, sf_dir, "lineitem").where("l_partkey % 7 <> 3").select(F.col("l_partkey").alias("node"))
    return lookups.missing(leaves, domained, on=["node"])


@_query("SELECT p_partkey AS node, CASE WHEN p_partkey % 5 = 0 THEN 'missing' WHEN p_partkey % 2 = 0 THEN 'formula' WHEN p_partkey % 3 = 0 THEN 'input' ELSE 'leaf' END AS role FROM part")
def audit_roles(spark, sf_dir):
    k = F.col("p_partkey")
    return _t(spark, sf_dir, "part").select(k.alias("node"), graph.audit_role(F.when(k % 2 == 0, F.lit("=A1")), F.when(k % 3 == 0, F.lit("input")), k % 5 != 0).alias("role"))


@_query(f"WITH {_EDGES_SQL} SELECT e.parent, e.child FROM edges e WHERE (e.parent LIKE 'nation%' OR e.parent LIKE 'region%') AND e.parent LIKE '%1%' AND (e.child LIKE 'nation%' OR e.child LIKE 'region%') AND e.child LIKE '%1%'")
def visible_edges(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    shown = nodes.withColumns({"role": F.when(F.col("sheet") == "customer", "internal").otherwise("input"), "formula": F.lit(None).cast("string")})
    return graph.visible(shown, edges, role="input", text="1")[1]


@_query(f"WITH {_EDGES_SQL} SELECT node AS member, 'unknown' AS fault FROM (SELECT 'region:' || (r_regionkey + 3) AS node FROM region) WHERE node NOT IN (SELECT node FROM nodes) UNION ALL SELECT 'nation:' || n_nationkey, 'several' FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey % 3 = 0")
def cluster_faults(spark, sf_dir):
    nodes, _ = _graph(spark, sf_dir)
    nation, region = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    of = lambda n: nation.where(f"n_nationkey % {n} = 0").select(F.lit(f"by{n}").alias("cluster"), F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string")).alias("node"))
    strange = region.select(F.lit("r").alias("cluster"), F.concat(F.lit("region:"), (F.col("r_regionkey") + 3).cast("string")).alias("node"))
    unknown, several = graph.clusters(nodes, of(2).unionByName(of(3)).unionByName(strange))
    fault = lambda df, name: df.select(F.col("node").alias("member"), F.lit(name).alias("fault"))
    return fault(unknown, "unknown").unionByName(fault(several, "several"))


@_query(f"""WITH {_EDGES_SQL} SELECT '{{"group":"nodes","data":{{"id":"' || node || '","role":"internal","sheet":"' || sheet || '"}}}}' AS element FROM nodes
UNION ALL SELECT '{{"group":"edges","data":{{"source":"' || child || '","target":"' || parent || '"}}}}' FROM edges""")
def graph_payload(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    return graph.payload(nodes.withColumn("role", F.lit("internal")), edges)


@_query("SELECT p_partkey AS node, p_brand AS role, round(p_retailprice - avg(p_retailprice) OVER (PARTITION BY p_brand), 4) AS x FROM part")
def centred_roles(spark, sf_dir):
    nodes = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), F.col("p_brand").alias("role"), F.col("p_retailprice").alias("x"))
    return graph.centred(nodes).select("node", "role", F.round("x", 4).alias("x"))


@_query("SELECT p_partkey AS partkey, p_size AS row FROM part WHERE NOT (p_brand IN ('Brand#11', 'Brand#22') AND p_size BETWEEN 5 AND 20)")
def without_blank(spark, sf_dir):
    nodes = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), F.col("p_brand").alias("sheet"), F.col("p_size").alias("row"), F.lit(1).alias("col"))
    blank = spark.createDataFrame([("Brand#11", 5, 1, 20, 3), ("Brand#22", 5, 1, 20, 3)], "sheet string, r1 int, c1 int, r2 int, c2 int").coalesce(1)
    return graph.without_blank(nodes, blank).select("partkey", "row")


@_query("SELECT s_suppkey AS parent, 'S' AS sheet, s_nationkey::INT AS row, CASE WHEN s_suppkey % 4 = 3 THEN NULL ELSE (1 + i)::INT END AS col FROM supplier, LATERAL (SELECT unnest(CASE s_suppkey % 4 WHEN 0 THEN [0] WHEN 1 THEN [0, 1] WHEN 2 THEN [0, 1, 2] ELSE [0] END) AS i)")
def dynamic_offsets(spark, sf_dir):
    """An edge for each step that the domain of an offset's control allows; none known for every fourth control."""
    refs = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("parent"), F.lit("S").alias("sheet"), F.col("s_nationkey").cast("int").alias("row"), F.lit(1).alias("col"), (F.col("s_suppkey") % 4).alias("control"))
    domains = spark.createDataFrame([(c, s) for c in range(3) for s in range(c + 1)], "control long, step int").coalesce(1)
    found = graph.dynamic_edges(refs, domains)
    return found.select("parent", F.lit("S").alias("sheet"), F.coalesce("child.row", F.lit(None)).alias("row0"), F.col("child.col").alias("col")).join(refs.select("parent", "row"), "parent").select("parent", "sheet", "row", "col")


@_query("SELECT c_custkey AS address, CASE WHEN c_custkey % 2 = 0 THEN 'input' ELSE 'constant' END AS kind FROM customer WHERE c_custkey % 3 <> 0")
def classified_unbound(spark, sf_dir):
    leaves = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("address"), F.when(F.col("c_custkey") % 2 == 0, "input").otherwise("constant").alias("kind"))
    return lookups.missing(leaves, leaves.where("address % 3 = 0"), on=["address", "kind"])


@_query(f"SELECT address, 'k:' || series_id AS key FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY list_position(['constant', 'input', 'output', 'internal'], direction) DESC, series_id DESC) AS n FROM ({_OWNED_SQL})) WHERE n = 1")
def key_map_precedence(spark, sf_dir):
    return lookups.key_maps(_owned(spark, sf_dir).withColumn("key", F.concat(F.lit("k:"), "series_id")))


@_query(f"SELECT address, count(*) AS n FROM ({_OWNED_SQL}) GROUP BY address HAVING count(*) > 1")
def owned_twice(spark, sf_dir):
    return lookups.repeated(_owned(spark, sf_dir), "address")


@_query("SELECT 'A' || p_size AS address, count(*) + (SELECT count(*) FROM part b WHERE b.p_partkey % 50 + 1 = a.p_size) AS n FROM part a GROUP BY p_size UNION ALL SELECT 'A' || k, count(*) FROM (SELECT p_partkey % 50 + 1 AS k FROM part) WHERE k NOT IN (SELECT p_size FROM part) GROUP BY k")
def reference_counts(spark, sf_dir):
    """Each part is a formula that names two cells, one with dollar signs; LOG10( and AB12X are no cells."""
    text = F.concat(F.lit("=LOG10($a$"), F.col("p_size").cast("string"), F.lit(")+AB12X*A"), (F.col("p_partkey") % 50 + 1).cast("string"))
    return audit.reference_counts(_t(spark, sf_dir, "part").select(text.alias("formula")))


@_query("SELECT user_id AS stage, sum(event_id % 7) AS seconds, max_by(event_type, event_id) AS outcome FROM events GROUP BY user_id")
def stage_timings(spark, sf_dir):
    spans = _t(spark, sf_dir, "events").select(F.col("user_id").alias("stage"), (F.col("event_id") % 7).alias("seconds"), F.col("event_type").alias("outcome"), F.col("event_id").alias("seq"))
    return audit.timings(spans)


@_query("SELECT l_orderkey AS parent, l_linenumber AS child FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_quantity > 25) DESC, l_linenumber) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber, max(l_quantity) OVER (PARTITION BY l_orderkey, l_linenumber) AS l_quantity FROM lineitem)) WHERE n <= 2")
def child_budget(spark, sf_dir):
    """For each order its first two lines, those of a large quantity first."""
    rows = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("child")).agg((F.max("l_quantity") > 25).alias("referenced"))
    return audit.budget(rows, 2).select("parent", "child")


@_query("SELECT c_nationkey AS sheet, count(*) AS n, string_agg('A' || row, ',' ORDER BY row) FILTER (i <= 12) AS first, greatest(count(*) - 12, 0) AS more FROM (SELECT c_nationkey, c_custkey AS row, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i FROM customer) GROUP BY c_nationkey")
def unbound_preview(spark, sf_dir):
    cells = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("sheet"), F.col("c_custkey").cast("int").alias("row"), F.lit(1).alias("col"))
    return bindings.unbound_by_sheet(cells).select("sheet", "n", F.array_join("first", ",").alias("first"), "more")


@_query("SELECT k AS address, min(o) AS ordinal FROM (SELECT c_nationkey AS k, c_custkey AS o FROM customer UNION ALL SELECT s_nationkey, s_suppkey FROM supplier) GROUP BY k")
def ordered_union(spark, sf_dir):
    a = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("address"), F.col("c_custkey").alias("ordinal"))
    return lookups.ordered_union(a, _t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("address"), F.col("s_suppkey").alias("ordinal")))


@_query("SELECT count(*) FILTER (p_size % 2 = 0) AS errors, count(*) FILTER (p_size % 2 <> 0) AS warnings, count(*) FILTER (p_size % 2 = 0) = 0 AS ok FROM part")
def finding_summary(spark, sf_dir):
    found = _t(spark, sf_dir, "part").select(F.when(F.col("p_size") % 2 == 0, "error").otherwise("warning").alias("severity"), *(F.lit("x").alias(c) for c in ("direction", "series_id", "code", "message", "address")))
    return bindings.summary(bindings.ordered(found))


# --- values ------------------------------------------------------------------------------------

_TYPED_SQL = "SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '#N/A' WHEN 3 THEN 'text' WHEN 4 THEN 'true' ELSE l_partkey::VARCHAR END AS a, l_quantity AS b FROM lineitem"


@_query(f"""SELECT orderkey, linenumber, CASE WHEN a = '#N/A' OR a = 'text' THEN NULL WHEN a IS NULL THEN 0.0::DOUBLE WHEN a = 'true' THEN 1.0::DOUBLE ELSE a::DOUBLE END + b AS plus,
CASE WHEN a = '#N/A' OR a = 'text' THEN NULL WHEN a IS NULL THEN 0.0::DOUBLE WHEN a = 'true' THEN 1.0::DOUBLE ELSE a::DOUBLE END * b AS times, CASE a WHEN '#N/A' THEN '#N/A' WHEN 'text' THEN '#VALUE!' END AS err FROM ({_TYPED_SQL})""")
def value_arithmetic(spark, sf_dir):
    """Blanks, errors, texts, flags and numbers in sums and products."""
    n = F.col("l_linenumber")
    text = F.when(n == 1, None).when(n == 2, "#N/A").when(n == 3, "text").when(n == 4, "true").otherwise(F.col("l_partkey").cast("string"))
    a, b = values.typed(text), values.value(F.col("l_quantity"))
    plus, times = values.add(a, b), values.mul(a, b)
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), n.alias("linenumber"), plus["num"].alias("plus"), times["num"].alias("times"), plus["err"].alias("err"))


@_query("SELECT c_custkey AS custkey, c_custkey % 2 = 0 AS same, c_acctbal >= c_nationkey AS more FROM customer")
def formula_equality(spark, sf_dir):
    """The sign = has no regard to case."""
    other = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.concat("c_mktsegment", F.lit(" ")))
    same = values.equal(values.value(text=F.col("c_mktsegment")), values.value(text=other))["bool"]
    more = values.at_least(values.value(F.col("c_acctbal")), values.value(F.col("c_nationkey")))["bool"]
    return _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), same.alias("same"), more.alias("more"))


@_query("SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, (1 + l_discount * 100 / 100) / (1 + l_tax * 100 / 100) AS factor, l_quantity * (l_discount * 100 - l_tax * 100) / 100 / (1 + l_tax * 100 / 100) AS balance FROM lineitem")
def debt_identities(spark, sf_dir):
    r, g = F.col("l_discount") * 100, F.col("l_tax") * 100
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), values.snowball(r, g).alias("factor"), values.stabilising_balance(F.col("l_quantity"), r, g).alias("balance"))


@_query("SELECT c_custkey AS custkey, round((c_acctbal + (2 * c_acctbal) / 1.05::DOUBLE) / 1.05::DOUBLE, 4) AS npv, round(c_acctbal / 7, 2) AS cut FROM customer")
def net_present_value(spark, sf_dir):
    npv = values.net_present_value(F.lit(0.05), F.array(F.col("c_acctbal"), F.col("c_acctbal") * 2))
    return _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.round(npv, 4).alias("npv"), values.rounded(F.col("c_acctbal") / 7, 2).alias("cut"))


@_query("SELECT p_partkey AS partkey, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice::BIGINT::VARCHAR ELSE p_partkey::VARCHAR || '.5' END AS text FROM part")
def coerced_numbers(spark, sf_dir):
    x = F.when(F.col("p_partkey") % 3 == 0, F.rint("p_retailprice")).otherwise(F.col("p_partkey") + 0.5)
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), values.coerced(x).alias("text"))


@_query("SELECT o_custkey AS custkey, CASE WHEN bool_and(k = 0) THEN 'bool' WHEN bool_and(k = 1) THEN 'int' WHEN bool_and(k IN (1, 2)) THEN 'float' ELSE 'string' END AS dtype FROM (SELECT o_custkey, o_orderkey % 3 AS k FROM orders) GROUP BY o_custkey")
def inferred_dtype(spark, sf_dir):
    kind = F.get(F.array(F.lit("bool"), F.lit("int"), F.lit("float")), (F.col("o_orderkey") % 3).cast("int"))
    return _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.collect_set(kind).alias("k")).select("custkey", values.dtype(F.col("k")).alias("dtype"))


# --- addresses ---------------------------------------------------------------------------------


@_query("SELECT p_partkey AS partkey, '''' || p_brand || '''!' || chr((65 + p_partkey % 26)::INT) || p_size AS address, p_size % 2 = 0 OR (p_partkey % 26 = 25 AND p_size = 9) AS named FROM part")
def normalised_addresses(spark, sf_dir):
    """Z9 also is named by Z99."""
    letter = F.lower(address.column_letters((F.col("p_partkey") % 26 + 1).cast("int")))
    text = F.concat(F.lit("'"), "p_brand", F.lit("'!$"), letter, F.lit("$"), F.col("p_size").cast("string"))
    formula_ = F.concat(F.lit("=Z99+$"), letter, F.lit("$"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).otherwise(0).cast("string"))
    cell = F.concat(F.upper(letter), F.col("p_size").cast("string"))
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), address.normalised(text).alias("address"), address.mentions(formula_, cell).alias("named"))


@_query("SELECT p_partkey AS partkey, CASE WHEN length(p_name) > 12 THEN left(p_name, 9) || '...' ELSE p_name END AS text, length(p_name) > 12 AS truncated, p_type AS header, CASE WHEN p_size <= 1 THEN 'scalar' ELSE 'row_series' END AS layout, p_size % 2 = 0 AS external FROM part")
def shown_texts(spark, sf_dir):
    p, short = _t(spark, sf_dir, "part"), address.truncated(F.col("p_name"), 12)
    header = address.header(F.concat(F.lit(" "), "p_type", F.lit(" (USD) ")), "strip_trailing_unit")
    link = F.when(F.col("p_size") % 2 == 0, "=[2]Sheet!A1").otherwise("=Sheet!A1")
    return p.select(F.col("p_partkey").alias("partkey"), short["text"].alias("text"), short["truncated"].alias("truncated"), header.alias("header"), bindings.suggested_layout(F.col("p_size")).alias("layout"), address.external(link).alias("external"))


@_query("SELECT p_partkey AS partkey, CASE WHEN p_size % 4 = 0 THEN 'A' || p_size ELSE 'A' || p_size || ':C' || (p_size + p_size % 4) END AS text FROM part")
def range_texts(spark, sf_dir):
    r = F.col("p_size")
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), address.range_text(r, F.lit(1), r + r % 4, F.when(r % 4 == 0, 1).otherwise(3)).alias("text"))


# --- bindings ----------------------------------------------------------------------------------


def _binding(spark, sf_dir):
    """A series for each supplier: a row of four periods, under a header row, with its nation as a label."""
    s = _t(spark, sf_dir, "supplier")
    row = (F.col("s_suppkey") + 5).cast("int")
    ranges = F.array(F.concat(F.lit("C"), row.cast("string"), F.lit(":D"), row.cast("string")), F.concat(F.lit("E"), row.cast("string"), F.lit(":F"), row.cast("string")))
    direction = F.get(F.array(F.lit("input"), F.lit("output"), F.lit("internal")), (F.col("s_suppkey") % 3).cast("int"))
    sets = s.select(F.col("s_name").alias("series_id"), F.lit("S").alias("sheet"), direction.alias("direction"), ranges.alias("data_ranges"))
    heads = spark.createDataFrame([("S", 1, c, float(2019 + c), None) for c in range(3, 7) if c != 5], "sheet string, row int, col int, num double, str string").coalesce(1)
    labels = s.select(F.lit("S").alias("sheet"), row.alias("row"), F.lit(1).alias("col"), F.lit(None).cast("double").alias("num"), F.when(F.col("s_suppkey") % 4 != 0, F.concat(F.lit(" nation "), F.col("s_nationkey").cast("string"), F.lit(" (code)"))).alias("str"))
    dims = s.select(F.col("s_name").alias("series_id"), F.explode(F.array(
        F.struct(F.lit("year").alias("dim_id"), F.lit("column_header").alias("bind_kind"), F.lit(1).alias("header_row"), F.lit(None).cast("string").alias("label_column"), F.lit(None).cast("string").alias("value"), (F.col("s_suppkey") % 2 == 0).alias("fill"), F.lit("strip").alias("normalize")),
        F.struct(F.lit("nation").alias("dim_id"), F.lit("row_label").alias("bind_kind"), F.lit(None).cast("int").alias("header_row"), F.lit("A").alias("label_column"), F.lit(None).cast("string").alias("value"), F.lit(False).alias("fill"), F.lit("strip_trailing_unit").alias("normalize")),
        F.struct(F.lit("unit").alias("dim_id"), F.lit("constant").alias("bind_kind"), F.lit(None).cast("int").alias("header_row"), F.lit(None).cast("string").alias("label_column"), F.lit("USD").alias("value"), F.lit(False).alias("fill"), F.lit("strip").alias("normalize")),
    )).alias("d")).select("series_id", "d.*")
    return sets, dims, heads.unionByName(labels)


_BOUND_SQL = "SELECT s_suppkey, s_nationkey, s_name AS series_id, (s_suppkey + 5)::INT AS row, c::INT AS col, (c - 2)::INT AS ordinal FROM supplier, (SELECT unnest([3, 4, 5, 6]) AS c)"


@_query(f"SELECT series_id, row, col, ordinal FROM ({_BOUND_SQL})")
def bound_cells(spark, sf_dir):
    return bindings.bound_cells(_binding(spark, sf_dir)[0]).select("series_id", "row", "col", "ordinal")


_KEYS_SQL = f"""SELECT series_id, row, col, 'year' AS dim_id, CASE WHEN col <> 5 THEN (2019 + col)::VARCHAR WHEN s_suppkey % 2 = 0 THEN '2023' END AS key, s_suppkey FROM ({_BOUND_SQL})
UNION ALL SELECT series_id, row, col, 'nation', CASE WHEN s_suppkey % 4 <> 0 THEN 'nation ' || s_nationkey END, s_suppkey FROM ({_BOUND_SQL})
UNION ALL SELECT series_id, row, col, 'unit', 'USD', s_suppkey FROM ({_BOUND_SQL})"""


@_query(f"SELECT series_id, row, col, dim_id, key FROM ({_KEYS_SQL})")
def resolved_keys(spark, sf_dir):
    """Keys from headers (one blank, filled for every second series), labels and constants."""
    sets, dims, cells = _binding(spark, sf_dir)
    return bindings.resolve_keys(bindings.bound_cells(sets), dims, cells).select("series_id", "row", "col", "dim_id", "key")


@_query(f"SELECT series_id, row, col, series_id || '[' || string_agg(key, ',' ORDER BY dim_id) || ']' AS label FROM ({_KEYS_SQL}) GROUP BY series_id, row, col")
def cell_labels(spark, sf_dir):
    sets, dims, cells = _binding(spark, sf_dir)
    bound = bindings.bound_cells(sets)
    keys = bindings.resolve_keys(bound, dims, cells).where("key IS NOT NULL")
    return bindings.labels(bound, keys)


@_query(f"""SELECT code, count(*) AS n FROM (
SELECT 'partial_bind_failure' AS code FROM ({_KEYS_SQL}) GROUP BY series_id HAVING count(key) < count(*)
UNION ALL SELECT 'sparse_label_without_fill' FROM ({_KEYS_SQL}) WHERE dim_id IN ('year', 'nation') AND key IS NULL AND (dim_id = 'nation' OR s_suppkey % 2 <> 0) GROUP BY series_id, dim_id
UNION ALL SELECT 'unbound_graph_cell' FROM supplier WHERE s_suppkey % 5 = 0) GROUP BY code""")
def binding_findings(spark, sf_dir):
    sets, dims, cells = _binding(spark, sf_dir)
    bound = bindings.bound_cells(sets)
    loose = _t(spark, sf_dir, "supplier").where("s_suppkey % 5 = 0").select(F.lit("S").alias("sheet"), F.col("s_suppkey").cast("int").alias("row"), F.lit(9).alias("col"))
    return bindings.audit(sets, bindings.resolve_keys(bound, dims, cells), bound, dims, loose).groupBy("code").agg(F.count("*").alias("n"))


@_query("SELECT s_name AS series_id, CASE WHEN s_suppkey % 3 = 0 THEN 'over' ELSE 'base' END AS kind FROM supplier")
def overlaid_domains(spark, sf_dir):
    base = _t(spark, sf_dir, "supplier").select(F.col("s_name").alias("series_id"), F.lit("base").alias("kind"))
    return bindings.overlaid(base, _t(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_name").alias("series_id"), F.lit("over").alias("kind")))


@_query(f"SELECT series_id, 'S!' || chr((64 + col)::INT) || row AS address, ordinal, CASE WHEN s_suppkey % 2 = 0 THEN 'USD' ELSE 'pct' END AS unit, '1 ≤ x ≤ 9' AS domain FROM ({_BOUND_SQL}) WHERE s_suppkey % 3 = 0")
def input_catalog(spark, sf_dir):
    sets, _, cells = _binding(spark, sf_dir)
    key = F.substring("series_id", 10, 20).cast("long")
    about = _t(spark, sf_dir, "supplier").select(F.col("s_name").alias("series_id"), F.lit("float").alias("dtype"), F.when(F.col("s_suppkey") % 2 == 0, "USD").alias("record_unit"), F.lit("pct").alias("attribute_unit"))
    domains = _t(spark, sf_dir, "supplier").select(F.col("s_name").alias("series_id"), F.lit("real_between").alias("kind"), F.lit(1.0).alias("lo"), F.lit(9.0).alias("hi"), F.lit(None).cast("array<string>").alias("vals"))
    return bindings.catalog(bindings.bound_cells(sets), about, domains, cells, "input").select("series_id", "address", "ordinal", "unit", "domain")


@_query("SELECT s_suppkey AS suppkey, s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 OR s_suppkey % 3 = 1 AND s_suppkey % 5 = 0 AS public FROM supplier")
def public_series(spark, sf_dir):
    k = F.col("s_suppkey")
    direction = F.get(F.array(F.lit("input"), F.lit("output"), F.lit("internal")), (k % 3).cast("int"))
    return _t(spark, sf_dir, "supplier").select(k.alias("suppkey"), bindings.public(direction, k % 2 == 0, k % 5 == 0).alias("public"))


# --- series accessors --------------------------------------------------------------------------


@_query("SELECT c_custkey AS custkey, c_acctbal AS picked, CASE WHEN c_custkey % 4 = 0 THEN 'lengths differ: 3, 2' END AS length_err, CASE WHEN c_custkey % 3 = 0 THEN 'no value for z' END AS key_err, CASE WHEN c_custkey % 3 = 0 THEN 'z' ELSE '' END AS lacking, c_custkey % 2 = 0 AS same FROM customer")
def strict_accessors(spark, sf_dir):
    """The raising forms over rows that are whole, the faults of rows that are not as columns."""
    k, x = F.col("c_custkey"), F.col("c_acctbal")
    held = F.create_map(F.lit("a"), x, F.lit("b"), x + 1)
    key = F.when(k % 3 == 0, "z").otherwise("a")
    short = F.when(k % 4 == 0, F.array(x, x)).otherwise(F.array(x, x, x))
    lines = series.zipped(key=F.array(F.lit("a"), F.lit("b")), value=series.ordered_values(held, F.array(F.lit("a"), F.lit("b"))))
    fields = F.when(k % 2 == 0, F.array(F.lit("t"), F.lit("c"))).otherwise(F.array(F.lit("t")))
    return _t(spark, sf_dir, "customer").select(
        k.alias("custkey"), F.least(series.selected(held, F.lit("a")), F.get(lines, F.lit(0))["value"]).alias("picked"), series.length_error(F.array(x, x, x), short).alias("length_err"), series.key_error(held, key).alias("key_err"),
        F.array_join(series.missing_keys(held, F.array(F.lit("a"), key)), ",").alias("lacking"), series.same_axes(fields, F.array(F.lit("c"), F.lit("t"))).alias("same"),
    )


@_query("SELECT c_custkey AS custkey, CASE WHEN c_custkey % 3 = 0 THEN 9.0::DOUBLE ELSE c_acctbal END AS first, CASE WHEN c_custkey % 3 = 1 THEN 9.0::DOUBLE ELSE c_acctbal END AS second FROM customer")
def overridden_elements(spark, sf_dir):
    arr = series.overridden(F.array("c_acctbal", "c_acctbal"), F.col("c_custkey") % 3, F.lit(9.0))
    return _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.get(arr, F.lit(0)).alias("first"), F.get(arr, F.lit(1)).alias("second"))


@_query("SELECT 's' || s_suppkey AS compute, 's' || s_suppkey || '[' || i || ']' AS label, CASE WHEN s_suppkey % 4 NOT IN (0, 3) THEN s_acctbal + i END AS value, CASE s_suppkey % 4 WHEN 0 THEN 'no values returned for s' || s_suppkey WHEN 3 THEN 's' || s_suppkey || ' returned 1 values for 2 cells' END AS err FROM supplier, (SELECT unnest([0, 1]) AS i)")
def output_catalogue(spark, sf_dir):
    s, name = _t(spark, sf_dir, "supplier"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    specs = s.select(name.alias("compute"), F.explode(F.array(F.lit(0), F.lit(1))).alias("ordinal")).withColumn("label", F.concat("compute", F.lit("["), F.col("ordinal").cast("string"), F.lit("]")))
    outputs = s.where("s_suppkey % 4 <> 0").select(name.alias("compute"), F.when(F.col("s_suppkey") % 4 == 3, F.array("s_acctbal")).otherwise(F.array(F.col("s_acctbal"), F.col("s_acctbal") + 1)).alias("values"))
    return series.catalogue(outputs, specs)


@_query("SELECT DISTINCT 'brand' AS input, p_type AS value, 'unknown label' AS failure FROM part WHERE p_partkey % 3 = 1 UNION ALL SELECT 'brand', 'nowhere', 'literal is no reference label' UNION ALL SELECT 'size', NULL, 'no reference labels for a literal'")
def label_failures(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    references = part.select(F.lit("brand").alias("input"), F.col("p_brand").alias("value")).distinct()
    literals = references.unionByName(spark.createDataFrame([("brand", "nowhere"), ("size", "1")], "input string, value string").coalesce(1))
    wanted = part.select(F.lit("brand").alias("input"), F.when(F.col("p_partkey") % 3 == 1, F.col("p_type")).otherwise(F.concat(F.lit(" "), "p_brand")).alias("value"))
    return series.label_failures(references, literals, wanted)


@_query("SELECT event_id, json_extract(props, '$.k')::VARCHAR AS k, '1' AS z, 0 AS n_unknown FROM events")
def normalised_requests(spark, sf_dir):
    requests = _t(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("props").alias("body"))
    found = model.normalised(requests, {"k": "0", "z": "1"})
    return found.select(F.col("id").alias("event_id"), F.col("inputs")["k"].alias("k"), F.col("inputs")["z"].alias("z"), F.size("unknown").alias("n_unknown"))


# --- the model from its formulas ---------------------------------------------------------------


@_query(_COMBO_SQL)
def formula_sweep(spark, sf_dir):
    """The full factorial evaluated from the workbook's formulas, as texts."""
    of = formula.book(model.sheet_cells(), domains={"Inputs!B22": [1, 2, 3]})
    writes = scenarios.cell_writes(scenarios.sweep(spark).where("grp = 'combo'"))
    found = formula.evaluate(of, writes, model.TARGETS)
    row, col = F.regexp_extract("address", "([0-9]+)$", 1), F.ascii(F.regexp_extract("address", "!([A-Z])", 1)) - 65
    name = F.when(row == "12", "baseline").when(row == "13", "shocked").otherwise("delta")
    return found.select("scenario_id", F.concat(F.lit("output_"), name, F.lit("["), col.cast("string"), F.lit("]")).alias("cell"), F.col("value.num").alias("num"))


@_query("SELECT c_custkey AS id, abs(CASE WHEN c_acctbal > 5000 THEN c_acctbal * 1.5::DOUBLE ELSE c_nationkey END) AS a, c_acctbal + c_nationkey + c_nationkey AS b, CASE WHEN c_nationkey = 0 THEN '#DIV/0!' END AS c FROM customer")
def formula_customers(spark, sf_dir):
    """Formulas with names, whole columns and errors over every customer."""
    cells = {"In!A1": None, "In!A2": None, "Out!B1": "=ABS(IF(bal>5e3,bal*150%,In!$A$2))", "Out!B2": "=SUM(In!A:A)+nation", "Out!B3": "=bal/nation"}
    of = formula.book(cells, names={"bal": "In!$A$1", "nation": "In!$A$2"})
    one = lambda a, c: F.struct(F.lit(a).alias("address"), F.col(c).cast("string").alias("value"))
    writes = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("scenario_id"), F.explode(F.array(one("In!A1", "c_acctbal"), one("In!A2", "c_nationkey"))).alias("x")).select("scenario_id", "x.*")
    found = formula.evaluate(of, writes, ["Out!B1", "Out!B2", "Out!B3"]).groupBy(F.col("scenario_id").alias("id"))
    pick = lambda a, field: F.max(F.when(F.col("address") == a, F.col("value")[field]))
    return found.agg(pick("Out!B1", "num").alias("a"), pick("Out!B2", "num").alias("b"), pick("Out!B3", "err").alias("c"))


@_query("SELECT * FROM (VALUES ('canonical', 12), ('single_axis', 61), ('combo', 45), ('error', 11)) AS v(grp, n)")
def scenario_groups(spark, sf_dir):
    return scenarios.sweep(spark).groupBy("grp").agg(F.count("*").alias("n"))


@_query("SELECT 'canonical:' || c || ':' || s AS scenario_id, CASE s WHEN 'growth' THEN -2.0 WHEN 'interest' THEN 2.0 WHEN 'primary_balance' THEN -1.0 ELSE 0.0 END::DOUBLE AS magnitude FROM (VALUES ('Borvelia'), ('Litellia'), ('Aurelium')) AS a(c), (VALUES ('baseline'), ('growth'), ('interest'), ('primary_balance')) AS b(s)")
def canonical_scenarios(spark, sf_dir):
    found = scenarios.sweep(spark).where("grp = 'canonical'")
    return found.select("scenario_id", F.aggregate("shock_table", F.lit(0.0), lambda s, x: s + x).alias("magnitude"))


@_query("SELECT o_orderkey AS orderkey, CASE WHEN o_orderkey % 4 = 0 THEN true WHEN o_orderkey % 4 = 1 THEN o_orderkey % 3 = 1 WHEN o_orderkey % 4 = 2 THEN true ELSE false END AS passed, o_orderkey % 4 = 0 OR (o_orderkey % 4 = 1 AND o_orderkey % 3 = 1) OR (o_orderkey % 4 = 2 AND o_orderkey % 5 = 0) AS healthy FROM orders")
def parity_health(spark, sf_dir):
    """Huge whole numbers, flags against numbers, errors declared or not, one blank."""
    k, digits = F.col("o_orderkey"), "9" * 320
    m = k % 4
    golden = F.when(m == 0, values.typed(F.lit(digits))).when(m == 1, values.value(flag=F.lit(True))).when(m == 2, values.value(err=F.lit("#N/A"))).otherwise(values.value(F.lit(1.0)))
    sut = F.when(m == 0, values.typed(F.lit(digits))).when(m == 1, values.value(k % 3)).when(m == 2, values.value(err=F.lit("#N/A"))).otherwise(values.value())
    o = _t(spark, sf_dir, "orders").withColumn("scenario_id", k)
    expected = o.select("scenario_id", (k % 5 == 0).alias("expects_error_values"))
    found = parity.compare(o.select("scenario_id", golden.alias("value")), o.select("scenario_id", sut.alias("value")), ["scenario_id"], expected)
    return found.select(F.col("scenario_id").alias("orderkey"), "passed", "healthy")


@_query("SELECT p_partkey AS partkey, f FROM part, LATERAL (SELECT unnest(['XLOOKUP', 'SUM', 'X_Y', 'A1.B']) AS f)")
def prefixed_functions(spark, sf_dir):
    """A prefix that ends in a dot is no part of a name; a letter, digit or underscore before one is."""
    text = F.concat(F.lit("=_xlfn.XLOOKUP(A"), F.col("p_partkey").cast("string"), F.lit(")+SUM(1)*x_Y(2)+9q(1)+A1.B(3)"))
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), F.explode(address.function_names(text)).alias("f"))


# --- inverses, closures and checks -------------------------------------------------------------


@_query(f"SELECT series_id, ordinal, s_nationkey + col AS value FROM ({_BOUND_SQL}) WHERE col <> 5")
def series_of_cells(spark, sf_dir):
    """Values by address back to the series that bind the addresses; cells of one column have no value."""
    bound = bindings.bound_cells(_binding(spark, sf_dir)[0])
    place = address.rendered(F.col("sheet"), F.col("row"), F.col("col"))
    s = _t(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 5).cast("int").alias("row"), "s_nationkey", F.explode(F.array(*(F.lit(c) for c in (3, 4, 6, 7)))).alias("col"))
    cells = s.select(address.rendered(F.lit("S"), F.col("row"), F.col("col")).alias("address"), (F.col("s_nationkey") + F.col("col")).alias("value"))
    found = lookups.series_of(cells, bound.select(place.alias("address"), "series_id", F.col("ordinal").alias("key")))
    return found.select("series_id", F.col("key").alias("ordinal"), "value")


@_query(f"WITH RECURSIVE {_EDGES_SQL}, x AS (SELECT 'region:1' AS node UNION SELECT parent FROM x JOIN edges ON child = node) SELECT node, length(node) AS before, length(node) + 1 AS after FROM x WHERE node NOT LIKE '%3'")
def changed_downstream(spark, sf_dir):
    """Every node's value is another but those that end in 3; only what depends on one region counts."""
    nodes, edges = _graph(spark, sf_dir)
    before = nodes.select("node", F.length("node").alias("v"))
    after = before.select("node", F.when(F.col("node").endswith("3"), F.col("v")).otherwise(F.col("v") + 1).alias("v"))
    below = graph.closure(edges, nodes.where("node = 'region:1'").select("node"))
    return lookups.changed(before, after, ["node"], "v", below)


@_query("SELECT 'In!A' || p_size AS address, count(DISTINCT p_brand) AS n_scenarios FROM part WHERE p_size NOT IN (SELECT s_nationkey FROM supplier) GROUP BY p_size")
def absent_inputs(spark, sf_dir):
    cell = lambda c: F.concat(F.lit("In!A"), F.col(c).cast("string")).alias("address")
    return parity.absent_inputs(_t(spark, sf_dir, "part").select(F.col("p_brand").alias("scenario_id"), cell("p_size")), _t(spark, sf_dir, "supplier").select(cell("s_nationkey")))


@_query("SELECT o_custkey AS custkey, o_orderkey::INT AS year, o_totalprice AS value FROM orders")
def inputs_by_year(spark, sf_dir):
    """Maps by text keys, as of JSON, to maps by whole numbers."""
    given = F.map_from_entries(F.collect_list(F.struct(F.col("o_orderkey").cast("string"), "o_totalprice")))
    maps = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(given.alias("m"))
    return maps.select("custkey", F.explode(model.by_year(F.col("m"))).alias("year", "value"))


@_query("SELECT 'f' || p_size AS compute, p_type AS key, count(DISTINCT p_brand) AS n FROM part WHERE p_size % 5 <> 0 GROUP BY ALL HAVING count(DISTINCT p_brand) > 1")
def compute_clashes(spark, sf_dir):
    """Series of one compute name; a fifth has no name."""
    p = _t(spark, sf_dir, "part").withColumn("series_id", F.concat_ws("/", F.col("p_size").cast("string"), "p_brand"))
    names = p.select("series_id", F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("f"), F.col("p_size").cast("string"))).alias("compute")).distinct()
    return bindings.compute_clashes(names, p.select("series_id", F.col("p_type").alias("key")))


@_query(f"""SELECT 'S!' || chr((64 + b.col)::INT) || b.row AS address, b.series_id, b.ordinal, b.series_id || '[' || string_agg(k.key, ',' ORDER BY k.dim_id) || ']' AS label
FROM ({_BOUND_SQL}) b JOIN ({_KEYS_SQL}) k ON k.series_id = b.series_id AND k.row = b.row AND k.col = b.col WHERE b.s_suppkey % 3 = 2 GROUP BY b.series_id, b.row, b.col, b.ordinal""")
def internal_index(spark, sf_dir):
    sets, dims, cells = _binding(spark, sf_dir)
    bound = bindings.bound_cells(sets)
    return bindings.internal_index(bound, bindings.resolve_keys(bound, dims, cells).where("key IS NOT NULL"))
