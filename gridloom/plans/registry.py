"""The engine's operators as queries over the driver's tables, each with SQL that gives the same rows.

``orders`` of a customer are a time series, ``customer - nation - region`` a lookup chain and a
dependency graph, ``lineitem`` rows parameters, ``events`` edits, ``documents`` texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import address, values
from ..operators import audit, bindings, graph, lookups, parity, recurrence, series
from . import model, scenarios

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def _load() -> None:
    from . import operator_queries  # noqa: F401  (it registers its queries)


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- recurrences -------------------------------------------------------------------------------

_STEPS_SQL = """
WITH RECURSIVE o AS (
  SELECT o_custkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_totalprice) AS n,
         (o_orderkey % 9)::DOUBLE AS r, (o_orderkey % 7)::DOUBLE AS g, o_totalprice / 100000.0::DOUBLE AS p FROM orders),
w AS (
  SELECT k, n, 100.0::DOUBLE * (1.0::DOUBLE + r / 100.0::DOUBLE) / (1.0::DOUBLE + g / 100.0::DOUBLE) - p AS d,
         100.0::DOUBLE * (1.0::DOUBLE + CASE WHEN n >= 3 THEN r + 1.0::DOUBLE ELSE r END / 100.0::DOUBLE) / (1.0::DOUBLE + g / 100.0::DOUBLE) - p AS s FROM o WHERE n = 1
  UNION ALL
  SELECT o.k, o.n, w.d * (1.0::DOUBLE + o.r / 100.0::DOUBLE) / (1.0::DOUBLE + o.g / 100.0::DOUBLE) - o.p,
         w.s * (1.0::DOUBLE + CASE WHEN o.n >= 3 THEN o.r + 1.0::DOUBLE ELSE o.r END / 100.0::DOUBLE) / (1.0::DOUBLE + o.g / 100.0::DOUBLE) - o.p
  FROM w JOIN o ON o.k = w.k AND o.n = w.n + 1)
"""


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders")
    fields = ((F.col("o_orderkey") % 9).cast("double").alias("r"), (F.col("o_orderkey") % 7).cast("double").alias("g"), (F.col("o_totalprice") / F.lit(100000.0)).alias("p"))
    return recurrence.series(orders, "o_custkey", ["o_orderdate", "o_orderkey", "o_totalprice"], *fields)


@_query(_STEPS_SQL + "SELECT k AS custkey, max(n) AS n, max_by(d, n) AS debt FROM w GROUP BY k")
def recurrence_path(spark, sf_dir):
    return _series(spark, sf_dir).select(F.col("o_custkey").alias("custkey"), F.size("s").cast("long").alias("n"), recurrence.last(F.lit(100.0), F.col("s")).alias("debt"))


@_query(_STEPS_SQL + "SELECT k AS custkey, n, d AS debt FROM w")
def recurrence_steps(spark, sf_dir):
    steps = _series(spark, sf_dir).select("o_custkey", F.posexplode(recurrence.path(F.lit(100.0), F.col("s"))).alias("k", "debt"))
    return steps.select(F.col("o_custkey").alias("custkey"), (F.col("k") + 1).cast("long").alias("n"), "debt")


@_query(_STEPS_SQL + "SELECT k AS custkey, n, round(d, 7) AS debt FROM w")
def recurrence_blocks(spark, sf_dir):
    """The steps by blocks of four periods, composed first."""
    fields = ((F.col("o_orderkey") % 9).alias("r"), (F.col("o_orderkey") % 7).alias("g"), (F.col("o_totalprice") / F.lit(100000.0)).alias("p"))
    orders = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderdate", "o_orderkey", "o_totalprice", *fields)
    found = recurrence.blocked_path(orders, "custkey", ["o_orderdate", "o_orderkey", "o_totalprice"], "r", "g", "p", F.lit(100.0), block=4)
    return found.select("custkey", "n", F.round("state", 7).alias("debt"))


def _shifted(s):
    return F.transform(s, lambda x, k: F.struct((x["r"] + F.when(k >= 2, 1.0).otherwise(0.0)).alias("r"), x["g"].alias("g"), x["p"].alias("p")))


@_query(_STEPS_SQL + "SELECT k AS custkey, n, s AS shocked FROM w")
def shocked_path(spark, sf_dir):
    steps = _series(spark, sf_dir).select("o_custkey", F.posexplode(recurrence.path(F.lit(100.0), _shifted(F.col("s")))).alias("k", "shocked"))
    return steps.select(F.col("o_custkey").alias("custkey"), (F.col("k") + 1).cast("long").alias("n"), "shocked")


@_query(_STEPS_SQL + "SELECT k AS custkey, n, s - d AS delta FROM w")
def path_delta(spark, sf_dir):
    s = _series(spark, sf_dir)
    both = F.zip_with(recurrence.path(F.lit(100.0), _shifted(F.col("s"))), recurrence.path(F.lit(100.0), F.col("s")), lambda a, b: a - b)
    return s.select(F.col("o_custkey").alias("custkey"), F.posexplode(both).alias("k", "delta")).select("custkey", (F.col("k") + 1).cast("long").alias("n"), "delta")


@_query("SELECT o_custkey AS custkey, o_orderkey AS orderkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_totalprice) >= 3 THEN 1 ELSE 0 END AS active FROM orders")
def threshold_activation(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey", "o_totalprice")
    on = values.if_(values.at_least(values.value(F.row_number().over(w)), values.value(3.0)), values.value(1.0), values.value(0.0))
    return _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), on["num"].cast("int").alias("active"))


@_query("SELECT o_orderkey AS orderkey, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_totalprice) AS prior FROM orders")
def prior_period(spark, sf_dir):
    found = recurrence.prior(_t(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey", "o_totalprice"], "o_totalprice")
    return found.select(F.col("o_orderkey").alias("orderkey"), "prior")


# --- the model ---------------------------------------------------------------------------------

_MODEL_INPUT = """
WITH RECURSIVE c(country, debt) AS (VALUES ('Borvelia', 60.0::DOUBLE), ('Litellia', 80.0::DOUBLE), ('Aurelium', 40.0::DOUBLE)),
t(t, g, r, p) AS (VALUES (1, 3.5::DOUBLE, 4.0::DOUBLE, -1.0::DOUBLE), (2, 3.5::DOUBLE, 4.0::DOUBLE, -0.5::DOUBLE), (3, 3.5::DOUBLE, 4.0::DOUBLE, 0.0::DOUBLE), (4, 3.5::DOUBLE, 4.0::DOUBLE, 0.5::DOUBLE), (5, 3.5::DOUBLE, 4.0::DOUBLE, 1.0::DOUBLE)),
m(k, mag) AS (VALUES (1, -2.0::DOUBLE), (2, 2.0::DOUBLE), (3, -1.0::DOUBLE)),
y AS (SELECT unnest(range(1, 6)) AS y),
"""
_COMBO_SQL = _MODEL_INPUT + """
s AS (SELECT 'combo:country=' || country || ':shock_type=' || k || ':shock_year=' || y AS id, debt, k, mag, y FROM c, m, y),
x AS (SELECT s.id, s.debt, t.t, t.g, t.r, t.p,
       t.g + CASE WHEN k = 1 THEN mag ELSE 0.0::DOUBLE END * CASE WHEN t >= y THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS g1,
       t.r + CASE WHEN k = 2 THEN mag ELSE 0.0::DOUBLE END * CASE WHEN t >= y THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS r1,
       t.p + CASE WHEN k = 3 THEN mag ELSE 0.0::DOUBLE END * CASE WHEN t >= y THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p1 FROM s, t),
w AS (SELECT id, 0 AS t, debt AS b, debt AS s FROM s
      UNION ALL
      SELECT w.id, x.t, w.b * (1.0::DOUBLE + x.r / 100.0::DOUBLE) / (1.0::DOUBLE + x.g / 100.0::DOUBLE) - x.p, w.s * (1.0::DOUBLE + x.r1 / 100.0::DOUBLE) / (1.0::DOUBLE + x.g1 / 100.0::DOUBLE) - x.p1
      FROM w JOIN x ON x.id = w.id AND x.t = w.t + 1)
SELECT id AS scenario_id, 'output_' || o.name || '[' || t || ']' AS cell, CASE o.name WHEN 'baseline' THEN b WHEN 'shocked' THEN s ELSE s - b END AS num
FROM w, (VALUES ('baseline'), ('shocked'), ('delta')) AS o(name) WHERE t > 0
"""


@_query(_COMBO_SQL)
def model_sweep(spark, sf_dir):
    """The full factorial of countries, shock types and shock years, every output cell."""
    sweep = scenarios.sweep(spark).where("grp = 'combo'")
    return model.long(model.evaluate(sweep)).select("scenario_id", "cell", F.col("value.num").alias("num"))


def _errors_sql() -> str:
    """The scenarios that end in errors, by hand: what each changes of the defaults."""
    g, r, p = [3.5] * 5, [4.0] * 5, [-1.0, -0.5, 0.0, 0.5, 1.0]
    odd = [
        ("unknown_country", "NULL", 1, 2, g, r, p), ("trailing_space", "NULL", 1, 2, g, r, p), ("shock_type_0", "60", 0, 2, g, r, p), ("shock_type_4", "60", 4, 2, g, r, p), ("shock_year_0", "60", 1, 0, g, r, p),
        ("shock_year_6", "60", 1, 6, g, r, p), ("shock_year_2.5", "60", 1, 2.5, g, r, p), ("growth_minus_100", "60", 1, 2, [3.5, 3.5, -100.0, 3.5, 3.5], r, p), ("blank_input", "60", 1, 2, g, [0.0, 4.0, 4.0, 4.0, 4.0], p),
        ("nan", "60", 1, 2, g, r, [0.0, "nan", 0.0, 0.0, 0.0]), ("infinite", "60", 1, 2, g, r, [0.0, "inf", 0.0, 0.0, 0.0]),
    ]
    rows = ", ".join(f"('error:{name}', {debt}::DOUBLE, {kind}, {year}::DOUBLE, {t + 1}, '{a[t]}'::DOUBLE, '{b[t]}'::DOUBLE, '{c[t]}'::DOUBLE)" for name, debt, kind, year, a, b, c in odd for t in range(5))
    on = "CASE WHEN t >= y THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return f"""WITH RECURSIVE q(id, debt, kind, y, t, g, r, p) AS (VALUES {rows}),
x AS (SELECT id, t, g, r, p, g + CASE kind WHEN 1 THEN -2.0::DOUBLE ELSE 0.0::DOUBLE END * {on} AS g1, r, p FROM q),
w AS (SELECT DISTINCT id, 0 AS t, debt AS b, debt AS s, CASE WHEN debt IS NULL THEN '#N/A' END AS be, CASE WHEN debt IS NULL THEN '#N/A' WHEN kind NOT BETWEEN 1 AND 3 THEN '#VALUE!' END AS se FROM q
UNION ALL SELECT w.id, x.t, CASE WHEN x.g = -100 THEN NULL ELSE w.b * (1.0::DOUBLE + x.r / 100.0::DOUBLE) / (1.0::DOUBLE + x.g / 100.0::DOUBLE) - x.p END, CASE WHEN x.g1 = -100 THEN NULL ELSE w.s * (1.0::DOUBLE + x.r / 100.0::DOUBLE) / (1.0::DOUBLE + x.g1 / 100.0::DOUBLE) - x.p END,
coalesce(w.be, CASE WHEN x.g = -100 THEN '#DIV/0!' END), coalesce(w.se, CASE WHEN x.g1 = -100 THEN '#DIV/0!' END) FROM w JOIN x ON x.id = w.id AND x.t = w.t + 1)
SELECT id AS scenario_id, 'output_' || o.name || '[' || t || ']' AS cell, CASE o.name WHEN 'baseline' THEN CASE WHEN be IS NULL THEN b END WHEN 'shocked' THEN CASE WHEN se IS NULL THEN s END ELSE CASE WHEN be IS NULL AND se IS NULL THEN s - b END END AS num,
CASE o.name WHEN 'baseline' THEN be WHEN 'shocked' THEN se ELSE coalesce(se, be) END AS err FROM w, (VALUES ('baseline'), ('shocked'), ('delta')) AS o(name) WHERE t > 0"""


@_query(_errors_sql())
def model_errors(spark, sf_dir):
    """The scenarios that end in error values or odd numbers."""
    sweep = scenarios.sweep(spark).where("grp = 'error'")
    return model.long(model.evaluate(sweep)).select("scenario_id", "cell", F.col("value.num").alias("num"), F.col("value.err").alias("err"))


@_query("SELECT r_name AS region, seg AS segment, k::INT AS k FROM region, (SELECT DISTINCT c_mktsegment AS seg FROM customer), (SELECT unnest(range(1, 6)) AS k)")
def scenario_factorial(spark, sf_dir):
    region = _t(spark, sf_dir, "region").select(F.col("r_name").alias("region"))
    segment = _t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment")).distinct()
    five = F.explode(F.sequence(F.lit(1), F.lit(5))).alias("k")
    return region.crossJoin(segment).select("region", "segment", five)  # the axes of a design: a few values each


@_query("SELECT n_name AS country, 'growth[' || y || ']=' || CASE WHEN x >= 0 THEN '+' ELSE '-' END || abs(x)::DECIMAL(3,1)::VARCHAR AS point, x::DOUBLE AS x FROM nation, (VALUES (1), (3), (5)) AS a(y), (VALUES (0.0), (1.5), (3.5), (-2.0)) AS b(x)")
def scenario_single_axis(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation").select(F.col("n_name").alias("country"), F.explode(F.array(*(F.lit(y) for y in (1, 3, 5)))).alias("y"))
    swept = nation.select("country", "y", F.explode(F.array(*(F.lit(x) for x in (0.0, 1.5, 3.5, -2.0)))).alias("x"))
    return swept.select("country", F.format_string("growth[%d]=%+.1f", "y", "x").alias("point"), "x")


@_query("SELECT r_name || ':' || s AS scenario_id, (s = 'baseline') AS calm FROM region, (VALUES ('baseline'), ('growth'), ('interest'), ('primary_balance')) AS x(s)")
def scenario_canonical(spark, sf_dir):
    shock = F.explode(F.array(*(F.lit(s) for s in scenarios.SHOCKS))).alias("s")
    return _t(spark, sf_dir, "region").select("r_name", shock).select(F.concat_ws(":", "r_name", "s").alias("scenario_id"), (F.col("s") == "baseline").alias("calm"))


# --- formulas ----------------------------------------------------------------------------------


@_query("SELECT c_custkey AS custkey, CASE WHEN n_name IS NULL OR c_custkey % 10 = 0 THEN NULL ELSE r_name END AS region, CASE WHEN n_name IS NULL OR c_custkey % 10 = 0 THEN '#N/A' END AS region_err FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def index_match_lookup(spark, sf_dir):
    key = F.when(F.col("c_custkey") % 10 != 0, F.col("c_nationkey"))  # every tenth customer has no key
    rows = _t(spark, sf_dir, "customer").select("c_custkey", key.alias("nationkey"))
    nation = lookups.index_match(rows, "nationkey", _t(spark, sf_dir, "nation"), "n_nationkey", "n_regionkey", "n_nationkey", "regionkey")
    found = lookups.index_match(nation.drop("regionkey_err"), "regionkey", _t(spark, sf_dir, "region"), "r_regionkey", "r_name", "r_regionkey", "region")
    return found.select(F.col("c_custkey").alias("custkey"), "region", "region_err")


@_query("SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, CASE l_linenumber WHEN 1 THEN l_discount WHEN 2 THEN l_tax WHEN 3 THEN l_quantity END AS picked FROM lineitem")
def offset_lookup(spark, sf_dir):
    strip = F.array("l_discount", "l_tax", "l_quantity")
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), values.offset(strip, values.value(F.col("l_linenumber") - 1))["num"].alias("picked"))


@_query("SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, CASE l_linenumber WHEN 1 THEN l_discount WHEN 2 THEN l_tax WHEN 3 THEN l_quantity END AS picked, CASE WHEN l_linenumber NOT IN (1, 2, 3) THEN '#VALUE!' END AS err FROM lineitem")
def choose_dispatch(spark, sf_dir):
    found = values.choose(values.value(F.col("l_linenumber")), *(values.value(F.col(c)) for c in ("l_discount", "l_tax", "l_quantity")))
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), found["num"].alias("picked"), found["err"].alias("err"))


@_query("SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS ratio, CASE WHEN l_discount = 0 THEN '#DIV/0!' END AS err FROM lineitem")
def safe_divide_errors(spark, sf_dir):
    found = values.div(values.value(F.col("l_tax")), values.value(F.col("l_discount")))
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), found["num"].alias("ratio"), found["err"].alias("err"))


@_query("SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, (1.0::DOUBLE + l_discount) / (1.0::DOUBLE + l_tax) AS factor, l_quantity * (l_discount - l_tax) / (1.0::DOUBLE + l_tax) AS balance FROM lineitem")
def stabilising_balance(spark, sf_dir):
    r, g = F.col("l_discount"), F.col("l_tax")
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), ((1 + r) / (1 + g)).alias("factor"), (F.col("l_quantity") * (r - g) / (1 + g)).alias("balance"))


@_query("SELECT o_orderkey AS orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 1.5::DOUBLE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders")
def sparse_overlay(spark, sf_dir):
    defaults = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("price"))
    changes = defaults.where("orderkey % 7 = 0 OR orderkey % 11 = 0").select("orderkey", F.when(F.col("orderkey") % 7 == 0, 1.5).alias("price"))
    return lookups.overlay(defaults, changes, ["orderkey"], "price")


@_query("SELECT c_custkey AS custkey, [CASE WHEN c_custkey % 3 = 0 THEN 9.0::DOUBLE ELSE c_acctbal END, CASE WHEN c_custkey % 3 = 1 THEN 9.0::DOUBLE ELSE c_acctbal END]::VARCHAR IS NOT NULL AS whole, CASE WHEN c_custkey % 3 = 0 THEN 9.0::DOUBLE ELSE c_acctbal END AS first FROM customer")
def override_element(spark, sf_dir):
    arr = series.overridden(F.array("c_acctbal", "c_acctbal"), F.col("c_custkey") % 3, F.lit(9.0))
    return _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), arr.isNotNull().alias("whole"), F.get(arr, F.lit(0)).alias("first"))


# --- comparison --------------------------------------------------------------------------------

_PARITY_SQL = """
WITH p AS (
  SELECT o_orderpriority AS axis, o_orderstatus AS point, o_orderkey AS orderkey, o_totalprice AS g,
    CASE o_orderkey % 5 WHEN 0 THEN o_totalprice + 0.0000001::DOUBLE WHEN 1 THEN o_totalprice * 1.01::DOUBLE WHEN 2 THEN NULL ELSE o_totalprice END AS s,
    CASE WHEN o_orderkey % 50 = 3 THEN '#N/A' END AS ge, CASE WHEN o_orderkey % 50 = 3 THEN CASE WHEN o_orderkey % 100 = 3 THEN '#N/A' ELSE '#DIV/0!' END END AS se FROM orders),
v AS (
  SELECT axis, point, orderkey, CASE WHEN ge IS NOT NULL OR se IS NOT NULL THEN coalesce(ge = se, false) WHEN s IS NULL THEN false
           ELSE abs(g - s) <= 1e-6::DOUBLE OR abs(g - s) / abs(g) <= 1e-12::DOUBLE END AS passed,
         CASE WHEN ge IS NOT NULL OR se IS NOT NULL THEN coalesce(ge = se, false) ELSE false END AS matched_error,
         CASE WHEN ge IS NULL AND se IS NULL AND s IS NOT NULL THEN abs(g - s) END AS abs_diff FROM p)
"""


def _parity(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    odd = k % 50 == 3
    golden = o.select(F.col("o_orderpriority").alias("axis"), F.col("o_orderstatus").alias("point"), k.alias("orderkey"), F.when(odd, values.value(err=F.lit("#N/A"))).otherwise(values.value(price)).alias("value"))
    off = F.when(k % 5 == 0, values.value(price + 1e-7)).when(k % 5 == 1, values.value(price * 1.01)).when(k % 5 == 2, values.value()).otherwise(values.value(price))
    sut = o.select(k.alias("orderkey"), F.when(odd & (k % 100 == 3), values.value(err=F.lit("#N/A"))).when(odd, values.value(err=F.lit("#DIV/0!"))).otherwise(off).alias("value"))
    return parity.compare(golden, sut.join(golden.select("orderkey", "axis", "point"), "orderkey"), ["axis", "point", "orderkey"])


@_query(_PARITY_SQL + "SELECT orderkey, passed, matched_error, abs_diff FROM v")
def parity_compare(spark, sf_dir):
    return _parity(spark, sf_dir).select("orderkey", "passed", "matched_error", "abs_diff")


@_query(_PARITY_SQL + "SELECT axis, point, count(*) AS n, count(*) FILTER (passed) AS n_passed, count(*) FILTER (matched_error) AS n_matched_error FROM v GROUP BY GROUPING SETS ((axis, point), (axis), ())")
def parity_rollup(spark, sf_dir):
    return parity.rollup(_parity(spark, sf_dir))


@_query(_PARITY_SQL + "SELECT axis, orderkey FROM v WHERE NOT passed ORDER BY axis, orderkey LIMIT 1")
def parity_first_divergence(spark, sf_dir):
    return parity.first_divergence(_parity(spark, sf_dir).select("axis", "orderkey", "passed"), ["axis", "orderkey"]).select("axis", "orderkey")


@_query(_PARITY_SQL + "SELECT orderkey, abs_diff FROM v WHERE NOT passed ORDER BY coalesce(abs_diff, 0) DESC, orderkey LIMIT 50")
def parity_topk_failures(spark, sf_dir):
    return parity.top_failures(_parity(spark, sf_dir), ["orderkey"]).select("orderkey", "abs_diff")


# --- keyed matching ----------------------------------------------------------------------------


@_query("SELECT c_custkey AS custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 40 = 0)")
def anti_unbound(spark, sf_dir):
    """Customers that no order binds; only an order whose number ends a block of forty does, so both sides have rows."""
    asked = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    return lookups.missing(asked, _t(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 40 == 0, F.col("o_custkey")).alias("custkey")), on=["custkey"])


@_query("SELECT c_custkey AS custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def semi_bound(spark, sf_dir):
    rich = _t(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("custkey"))
    return lookups.bound(_t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey")), rich, ["custkey"])


@_query("(SELECT c_nationkey + 25 * c_custkey AS k, 'left' AS side FROM customer EXCEPT SELECT s_nationkey + 25 * s_suppkey, 'left' FROM supplier) UNION ALL (SELECT s_nationkey + 25 * s_suppkey, 'right' FROM supplier EXCEPT SELECT c_nationkey + 25 * c_custkey, 'right' FROM customer)")
def set_diff_keys(spark, sf_dir):
    """All customers and suppliers; a key is shared where the same number has the same nation."""
    a = _t(spark, sf_dir, "customer").select((F.col("c_nationkey") + 25 * F.col("c_custkey")).alias("k")).distinct()
    return lookups.set_difference(a, _t(spark, sf_dir, "supplier").select((F.col("s_nationkey") + 25 * F.col("s_suppkey")).alias("k")).distinct())


_OWNED_SQL = "SELECT c_nationkey + 25 * (c_custkey // 60) AS address, c_name AS series_id, CASE c_custkey % 4 WHEN 0 THEN 'input' WHEN 1 THEN 'output' WHEN 2 THEN 'constant' ELSE 'internal' END AS direction FROM customer"


def _owned(spark, sf_dir):
    """All customers, a few to an address: a nation among 60 customers."""
    direction = F.get(F.array(*(F.lit(d) for d in ("input", "output", "constant", "internal"))), (F.col("c_custkey") % 4).cast("int"))
    place = F.col("c_nationkey") + 25 * F.floor(F.col("c_custkey") / 60)
    return _t(spark, sf_dir, "customer").select(place.alias("address"), F.col("c_name").alias("series_id"), direction.alias("direction"))


@_query(f"SELECT address, series_id, direction FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY list_position(['internal', 'constant', 'output', 'input'], direction), series_id) AS n FROM ({_OWNED_SQL})) WHERE n = 1")
def owner_precedence(spark, sf_dir):
    return lookups.owner(_owned(spark, sf_dir))


@_query(f"SELECT address, direction, count(DISTINCT series_id) AS n FROM ({_OWNED_SQL}) GROUP BY ALL HAVING count(DISTINCT series_id) > 1")
def owner_contested(spark, sf_dir):
    return lookups.contested(_owned(spark, sf_dir))


@_query("SELECT p_brand AS brand, p_size AS size, CASE WHEN count(*) OVER (PARTITION BY p_brand, p_size) = 1 THEN p_name END AS spec FROM part")
def ambiguous_null(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_name").alias("spec"))
    return lookups.unambiguous(rows, ["brand", "size"], "spec")


@_query("SELECT o_orderkey AS orderkey, o_totalprice AS before, o_totalprice + 1 AS after FROM orders WHERE o_orderkey % 13 = 0")
def changed_values(spark, sf_dir):
    before = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("price"))
    after = before.withColumn("price", F.when(F.col("orderkey") % 13 == 0, F.col("price") + 1).otherwise(F.col("price")))
    return lookups.changed(before, after, ["orderkey"], "price")


# --- graph -------------------------------------------------------------------------------------

_EDGES_SQL = """
nodes AS (SELECT 'region' AS sheet, 'region:' || r_regionkey AS node FROM region UNION ALL SELECT 'nation', 'nation:' || n_nationkey FROM nation UNION ALL SELECT 'customer', 'customer:' || c_custkey FROM customer),
edges AS (SELECT DISTINCT 'nation:' || n_nationkey AS parent, 'region:' || n_regionkey AS child FROM nation UNION ALL SELECT DISTINCT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer)
"""


def _graph(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    name = lambda table, col: F.concat(F.lit(f"{table}:"), F.col(col).cast("string"))
    r, n, c = (_t(spark, sf_dir, x) for x in ("region", "nation", "customer"))
    nodes = r.select(F.lit("region").alias("sheet"), name("region", "r_regionkey").alias("node")).unionByName(n.select(F.lit("nation").alias("sheet"), name("nation", "n_nationkey").alias("node"))).unionByName(c.select(F.lit("customer").alias("sheet"), name("customer", "c_custkey").alias("node")))
    edges = n.select(name("nation", "n_nationkey").alias("parent"), name("region", "n_regionkey").alias("child")).unionByName(c.select(name("customer", "c_custkey").alias("parent"), name("nation", "c_nationkey").alias("child"))).distinct()
    return nodes, edges


@_query(f"WITH {_EDGES_SQL} SELECT child AS source, parent AS target FROM edges")
def graph_edges(spark, sf_dir):
    return graph.producers(_graph(spark, sf_dir)[1])


@_query(f"WITH RECURSIVE {_EDGES_SQL}, x AS (SELECT 'region:1' AS node UNION SELECT parent FROM x JOIN edges ON child = node) SELECT node FROM x")
def graph_closure(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    return graph.closure(edges, nodes.where("node = 'region:1'").select("node"))


@_query(f"WITH RECURSIVE {_EDGES_SQL}, x AS (SELECT node, 0 AS layer FROM nodes UNION ALL SELECT parent, layer + 1 FROM x JOIN edges ON child = node) SELECT node, max(layer) AS layer FROM x GROUP BY node")
def graph_layers(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    return graph.layers(nodes.select("node"), edges)


@_query(f"WITH {_EDGES_SQL} SELECT n.sheet, count(DISTINCT n.node) AS n_nodes, count(e.parent) AS n_edges FROM nodes n LEFT JOIN edges e ON e.child = n.node GROUP BY n.sheet")
def graph_topology(spark, sf_dir):
    return graph.topology(*_graph(spark, sf_dir))


@_query(f"WITH {_EDGES_SQL} SELECT (SELECT count(DISTINCT node) FROM nodes) AS node_count, (SELECT count(*) FROM edges) AS edge_count, (SELECT count(DISTINCT node) FROM nodes WHERE node NOT IN (SELECT parent FROM edges)) AS leaf_count, 0 AS provenance_edge_count")
def graph_summary(spark, sf_dir):
    return graph.summary(*_graph(spark, sf_dir))


@_query(f"WITH {_EDGES_SQL} SELECT node, CASE WHEN node LIKE 'customer:%1' THEN 'target' WHEN sheet = 'customer' THEN 'output' WHEN sheet = 'region' THEN 'input' WHEN node = 'nation:3' THEN 'constant' ELSE 'internal' END AS role FROM nodes")
def node_roles(spark, sf_dir):
    nodes, _ = _graph(spark, sf_dir)
    some = lambda where: nodes.where(where).select("node")
    return graph.roles(nodes, some("node LIKE 'customer:%1'"), some("sheet = 'customer'"), some("sheet = 'region' OR node LIKE 'customer:2%'"), some("node = 'nation:3'"))


@_query(f"WITH {_EDGES_SQL} SELECT parent, child FROM edges WHERE parent NOT IN (SELECT node FROM nodes WHERE node NOT LIKE '%7') OR child NOT IN (SELECT node FROM nodes WHERE node NOT LIKE '%7')")
def graph_unknown_ends(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    return graph.unknown_ends(nodes.where("node NOT LIKE '%7'"), edges)


# --- ranges and addresses ----------------------------------------------------------------------


@_query("SELECT k, min(o_custkey) AS first_key, max(o_custkey) AS last_key, count(*) AS n FROM (SELECT k, o_custkey, o_custkey - row_number() OVER (PARTITION BY k ORDER BY o_custkey) AS i FROM (SELECT DISTINCT o_orderpriority AS k, o_custkey FROM orders)) GROUP BY k, i")
def islands(spark, sf_dir):
    cells = _t(spark, sf_dir, "orders").select(F.lit(1).alias("row"), F.col("o_orderpriority").alias("k"), F.col("o_custkey").alias("col"))
    return bindings.spans(cells, ["k"]).select("k", F.col("c1").alias("first_key"), F.col("c2").alias("last_key"), (F.col("c2") - F.col("c1") + 1).alias("n"))


_RECT_SQL = """
WITH c AS (SELECT DISTINCT l_suppkey AS sheet, (l_orderkey % 401)::BIGINT AS r, (l_linenumber % 3 + 1)::BIGINT AS c FROM lineitem),
s AS (SELECT sheet, r, min(c) AS c1, max(c) AS c2 FROM (SELECT *, c - row_number() OVER (PARTITION BY sheet, r ORDER BY c) AS i FROM c) GROUP BY sheet, r, i),
g AS (SELECT sheet, r, string_agg(c1 || '-' || c2, ',' ORDER BY c1) AS sig FROM s GROUP BY sheet, r),
m AS (SELECT sheet, sig, min(r) AS r1, max(r) AS r2 FROM (SELECT *, r - row_number() OVER (PARTITION BY sheet, sig ORDER BY r) AS i FROM g) GROUP BY sheet, sig, i)
SELECT m.sheet, r1, c1, r2, c2 FROM m JOIN s ON s.sheet = m.sheet AND s.r = m.r1
"""


@_query(_RECT_SQL)
def rectangles(spark, sf_dir):
    """All of lineitem, a sheet for each supplier, where cells are spread by order and line and leave gaps."""
    cells = _t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sheet"), (F.col("l_orderkey") % 401).alias("row"), (F.col("l_linenumber") % 3 + 1).alias("col"))
    return bindings.rectangles(cells, ["sheet"]).select("sheet", "r1", "c1", "r2", "c2")


@_query("SELECT o_custkey AS custkey, o_orderkey AS orderkey, last_value(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS label FROM orders")
def header_fill(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("label"))
    return bindings.filled(rows, ["custkey"], "orderkey", "label")


_LETTERS_SQL = "CASE WHEN n <= 26 THEN chr((64 + n)::INT) ELSE chr((64 + (n - 1) // 26)::INT) || chr((65 + (n - 1) % 26)::INT) END"


@_query(f"SELECT partkey, n, {_LETTERS_SQL} AS letters FROM (SELECT p_partkey AS partkey, (p_partkey % 702 + 1)::INT AS n FROM part)")
def col_letters(spark, sf_dir):
    n = (F.col("p_partkey") % 702 + 1).cast("int")
    letters = address.column_letters(n)
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), address.column_number(letters).alias("n"), letters.alias("letters"))


@_query("SELECT p_partkey AS partkey, p_brand AS sheet, p_size::INT AS row, (p_partkey % 26 + 1)::INT AS col FROM part")
def address_parse(spark, sf_dir):
    text = F.concat(F.lit("'"), "p_brand", F.lit("'!$"), F.lower(address.column_letters((F.col("p_partkey") % 26 + 1).cast("int"))), F.lit("$"), F.col("p_size").cast("string"))
    return _t(spark, sf_dir, "part").select("p_partkey", address.parsed(text).alias("x")).select(F.col("p_partkey").alias("partkey"), "x.*")


@_query("SELECT p_partkey AS partkey, r::INT AS row, c::INT AS col FROM part, (SELECT unnest(range(0, 3)) AS i) a, (SELECT unnest(range(0, 2)) AS j) b, LATERAL (SELECT p_size + i AS r, p_partkey % 20 + 1 + j AS c)")
def range_expand(spark, sf_dir):
    col, row = (F.col("p_partkey") % 20 + 1).cast("int"), F.col("p_size")
    ranges = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), address.range_text(row, col, row + 2, col + 1).alias("range"))
    return address.expanded(ranges).drop("range")


@_query("SELECT p_partkey AS partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand WHEN p_partkey % 3 = 1 THEN trim(p_brand) END AS label, CASE WHEN p_partkey % 3 = 2 THEN 'unknown' END AS err FROM part")
def label_resolve(spark, sf_dir):
    wanted = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit(" "), "p_brand", F.lit("  "))).otherwise("nowhere")
    part = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), wanted.alias("wanted"))
    return address.resolved_labels(part, "wanted", _t(spark, sf_dir, "part").select(F.col("p_brand").alias("choice"))).select("partkey", "label", "err")


# --- audit -------------------------------------------------------------------------------------


# Upper case as Spark has it: DuckDB maps a letter to one letter, these become more, of A-Z among others.
_UPPER_SQL = "formula"
for _c in "ßŉǰẖẗẘẙẚﬀﬁﬂﬃﬄﬅﬆ":
    _UPPER_SQL = f"replace({_UPPER_SQL}, '{_c}', '{_c.upper()}')"


@_query(rf"SELECT f AS function, count(*) AS n_calls, count(DISTINCT id) AS n_formulas, f IN ('OFFSET','INDEX','MATCH','CHOOSE','INDIRECT','XLOOKUP','HLOOKUP','VLOOKUP','LOOKUP') AS dynamic FROM (SELECT id, unnest(regexp_extract_all(replace(upper({_UPPER_SQL}), '(', '( '), '(?:^|[^A-Z0-9_])([A-Z][A-Z0-9_.]*)\(', 1)) AS f FROM (SELECT doc_id AS id, translate(text, chr(32) || chr(9) || chr(10), '(((') AS formula FROM documents)) GROUP BY f")
def function_calls(spark, sf_dir):
    """Every document as a formula of its whole text, where a word before a space, tab or line break is a call."""
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.translate("text", " \t\n", "(((").alias("formula"))
    return audit.function_calls(docs)


@_query(r"SELECT name, count(DISTINCT doc_id) AS n_formulas FROM (VALUES ('the'), ('of'), ('Nation'), ('zzz')) AS v(name) LEFT JOIN (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z_\\][a-z0-9_.\\]*')) AS w FROM documents) ON w = lower(name) GROUP BY name")
def name_usage(spark, sf_dir):
    names = spark.createDataFrame([("the",), ("of",), ("Nation",), ("zzz",)], "name string").coalesce(1)
    return audit.name_usage(_t(spark, sf_dir, "documents").select(F.col("text").alias("formula")), names)


@_query("SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_quantity AS quantity FROM lineitem WHERE NOT (l_quantity >= 5 AND l_quantity <= 45 AND l_quantity = floor(l_quantity)) OR NOT (l_discount <= 0.08::DOUBLE) OR l_returnflag NOT IN ('A', 'N')")
def domain_violations(spark, sf_dir):
    none, l = F.lit(None).cast("array<string>"), _t(spark, sf_dir, "lineitem")  # noqa: E741
    q = bindings.within(F.lit("between"), F.lit(5.0), F.lit(45.0), none, F.col("l_quantity"), F.lit(None).cast("string"))
    d = bindings.within(F.lit("real_between"), F.lit(None).cast("double"), F.lit(0.08), none, F.col("l_discount"), F.lit(None).cast("string"))
    e = bindings.within(F.lit("enum"), F.lit(None).cast("double"), F.lit(None).cast("double"), F.array(F.lit("A"), F.lit("N")), F.lit(None).cast("double"), F.col("l_returnflag"))
    return l.where(~(q & d & e)).select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), F.col("l_quantity").alias("quantity"))


@_query("SELECT p_partkey AS partkey, p_size AS size FROM part WHERE NOT coalesce(CASE p_partkey % 3 WHEN 0 THEN (p_size % 4 < 4) WHEN 1 THEN p_size % 4 = 0 ELSE p_size % 4 IN (1, 2) END AND p_size % 4 <> 3, false)")
def dtype_mismatch(spark, sf_dir):
    kind = F.get(F.array(F.lit("enum"), F.lit("between"), F.lit("real_between")), (F.col("p_partkey") % 3).cast("int"))
    dtype = F.get(F.array(F.lit("int"), F.lit("float"), F.lit("number"), F.lit(None).cast("string")), F.col("p_size") % 4)
    return _t(spark, sf_dir, "part").where(~bindings.dtype_agrees(kind, dtype)).select(F.col("p_partkey").alias("partkey"), F.col("p_size").alias("size"))


@_query("SELECT user_id, max_by(event_type, (ts, event_id)) AS outcome, count(*) AS n FROM events GROUP BY user_id")
def latest_outcome(spark, sf_dir):
    return _t(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("outcome"), F.count("*").alias("n"))


@_query("SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def json_flatten(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", model.given(F.col("props"), "k int")["k"].alias("k"))


@_query("SELECT o_custkey AS custkey, sha256(string_agg(o_orderkey::VARCHAR || ':' || o_orderpriority, ',' ORDER BY o_orderkey, o_orderpriority)) AS fingerprint FROM orders GROUP BY o_custkey")
def fingerprint(spark, sf_dir):
    from . import cache

    return cache.digests(_t(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey"), "custkey", "o_orderkey", "o_orderpriority")


@_query("SELECT c_custkey AS custkey FROM customer ORDER BY c_custkey % 97 <> 0, md5('0:' || c_custkey::VARCHAR), c_custkey LIMIT 40")
def sample_top(spark, sf_dir):
    rows = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    return audit.sample(rows, "custkey", 40, rows.where("custkey % 97 = 0"))


@_query("SELECT c_nationkey AS sheet, count(*) AS n, greatest(count(*) - 12, 0) AS more FROM customer GROUP BY c_nationkey")
def unbound_by_sheet(spark, sf_dir):
    cells = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("sheet"), F.col("c_custkey").cast("int").alias("row"), F.lit(1).alias("col"))
    return bindings.unbound_by_sheet(cells).select("sheet", "n", "more")


@_query("SELECT l_suppkey || l_linestatus AS parent, count(*) AS n_deps, count(*) FILTER (l_linenumber IN (1, 2) OR l_quantity > 45) AS n_special, count(DISTINCT CASE WHEN l_returnflag <> 'N' THEN l_returnflag END) AS n_sheets FROM lineitem GROUP BY ALL HAVING count(*) <= 300")
def difficulty(spark, sf_dir):
    """A parent for each supplier and line status; some depend on more than the operator's 300."""
    causes = F.when(F.col("l_linenumber") == 1, F.array(F.lit("dynamic_offset"))).when(F.col("l_linenumber") == 2, F.array(F.lit("dynamic_indirect"), F.lit("direct"))).otherwise(F.array(F.lit("direct")))
    guard = F.when(F.col("l_quantity") > 45, "x > 0")
    parent = F.concat(F.col("l_suppkey").cast("string"), "l_linestatus")
    return audit.difficulty(_t(spark, sf_dir, "lineitem").select(parent.alias("parent"), F.lit("N").alias("parent_sheet"), F.col("l_returnflag").alias("child_sheet"), causes.alias("causes"), guard.alias("guard")))


@_query("SELECT p_partkey AS partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || ' ≤ x ≤ ' || (p_size + 5) WHEN 1 THEN 'x ≤ ' || (p_size + 5) WHEN 2 THEN p_size || ' ≤ x' ELSE 'any' END AS domain, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE p_type END AS unit FROM part")
def catalog_inputs(spark, sf_dir):
    k, size = F.col("p_partkey") % 4, F.col("p_size").cast("double")
    text = bindings.domain_text(F.lit("real_between"), F.when(k.isin(0, 2), size), F.when(k.isin(0, 1), size + 5), F.lit(None).cast("array<string>"))
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), text.alias("domain"), F.coalesce(F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")), F.col("p_type")).alias("unit"))


@_query("SELECT coalesce(a.k, b.k) AS label, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'unchecked' ELSE 'changed' END AS state FROM (SELECT c_custkey AS k, c_name AS f FROM customer WHERE c_custkey % 5 <> 0) a FULL JOIN (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE c_name END AS f FROM customer WHERE c_custkey % 6 <> 0) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.f <> b.f")
def manifest_drift(spark, sf_dir):
    from . import cache

    c = _t(spark, sf_dir, "customer")
    before = c.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("label"), F.col("c_name").alias("fingerprint"))
    now = c.where("c_custkey % 6 <> 0").select(F.col("c_custkey").alias("label"), F.when(F.col("c_custkey") % 7 == 0, "x").otherwise(F.col("c_name")).alias("fingerprint"))
    return cache.drift(before, now)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scenarios of the sweep by output cell, and the recurrence over the orders of every customer."""
    swept = model.long(model.evaluate(scenarios.sweep(spark))).select("scenario_id", "cell", F.col("value.num").alias("num"), F.col("value.err").alias("err"))
    paths = recurrence_path(spark, sf_dir).select(F.concat(F.lit("customer:"), "custkey").alias("scenario_id"), F.lit("debt").alias("cell"), F.col("debt").alias("num"), F.lit(None).cast("string").alias("err"))
    return swept.unionByName(paths)
