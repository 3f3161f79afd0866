"""Series bindings: ranges to cells, keys from headers and labels, coverage, findings, catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import address


def bound_cells(series: DataFrame, excludes: DataFrame | None = None) -> DataFrame:
    """``(series_id, sheet, direction, row, col, ordinal)`` of every cell of ``series.data_ranges``."""
    ranges = series.select("series_id", "sheet", "direction", F.posexplode("data_ranges").alias("part", "range"))
    cells = address.expanded(ranges)
    if excludes is not None:
        gone = address.expanded(excludes).select("series_id", "row", "col")
        cells = cells.join(gone, ["series_id", "row", "col"], "left_anti")
    place = Window.partitionBy("series_id").orderBy("part", "row", "col")
    return cells.withColumn("ordinal", F.row_number().over(place)).drop("part", "range")


def filled(labels: DataFrame, partition: list[str], order: str, field: str) -> DataFrame:
    """Labels with blanks filled from the last one before, in order."""
    before = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return labels.withColumn(field, F.last(field, ignorenulls=True).over(before))


def resolve_keys(bound: DataFrame, dims: DataFrame, cells: DataFrame) -> DataFrame:
    """``(series_id, row, col, dim_id, key)``: each bound cell's key in each dimension.

    ``dims.bind_kind``: ``column_header`` reads the cell above in ``header_row``, ``row_label``
    the one beside in ``label_column``, ``constant`` takes ``value``, ``data_cell`` the cell itself.
    A blank label leaves a null key.
    """
    text = F.coalesce("str", F.when(F.col("num").isNotNull(), F.when(F.col("num") == F.floor("num"), F.col("num").cast("long").cast("string")).otherwise(F.col("num").cast("string"))))
    labels = cells.select(F.col("sheet"), F.col("row").alias("__r"), F.col("col").alias("__c"), text.alias("label"))
    at = bound.join(dims, "series_id")
    row = F.when(F.col("bind_kind") == "column_header", F.col("header_row")).otherwise(F.col("row"))
    col = F.when(F.col("bind_kind") == "row_label", address.column_number(F.col("label_column"))).otherwise(F.col("col"))
    found = at.withColumn("__r", row).withColumn("__c", col).join(labels, ["sheet", "__r", "__c"], "left")
    raw = F.when(F.col("bind_kind") == "constant", F.col("value")).otherwise(F.col("label"))
    key = F.when(F.col("normalize") == "strip_trailing_unit", address.header(raw, "strip_trailing_unit")).when(F.col("normalize") == "strip", F.trim(raw)).otherwise(raw)
    out = found.select("series_id", "sheet", "row", "col", "dim_id", "fill", F.nullif(key, F.lit("")).alias("key"))
    before = Window.partitionBy("series_id", "dim_id", "row").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("key", F.when(F.coalesce("fill", F.lit(False)), F.last("key", ignorenulls=True).over(before)).otherwise(F.col("key"))).drop("fill")


def spans(cells: DataFrame, partition: list[str] | None = None) -> DataFrame:
    """Runs of neighbouring columns in a row: ``(..., row, c1, c2)``."""
    keys = [*(partition or []), "row"]
    island = F.col("col") - F.row_number().over(Window.partitionBy(*keys).orderBy("col"))
    return cells.select(*keys, "col").distinct().withColumn("__i", island).groupBy(*keys, "__i").agg(F.min("col").alias("c1"), F.max("col").alias("c2")).drop("__i")


def rectangles(cells: DataFrame, partition: list[str] | None = None) -> DataFrame:
    """Rectangles ``(..., r1, c1, r2, c2, range)``: rows that follow each other with the same runs are one."""
    keys = partition or []
    runs = spans(cells, keys)
    rows = runs.groupBy(*keys, "row").agg(F.array_sort(F.collect_list(F.struct("c1", "c2"))).alias("runs"))
    island = F.col("row") - F.row_number().over(Window.partitionBy(*keys, "runs").orderBy("row"))
    merged = rows.withColumn("__i", island).groupBy(*keys, "runs", "__i").agg(F.min("row").alias("r1"), F.max("row").alias("r2"))
    out = merged.select(*keys, "r1", "r2", F.explode("runs").alias("x")).select(*keys, "r1", "x.c1", "r2", "x.c2")
    return out.withColumn("range", address.range_text(F.col("r1"), F.col("c1"), F.col("r2"), F.col("c2")))


def suggested_layout(n: Column) -> Column:
    return F.when(n <= 1, "scalar").otherwise("row_series")


def unbound_by_sheet(unbound: DataFrame, preview: int = 12) -> DataFrame:
    """Sheets with unbound cells, busiest first, with the first few addresses and how many more there are."""
    place = F.row_number().over(Window.partitionBy("sheet").orderBy("row", "col"))
    some = unbound.withColumn("__n", place)
    text = F.concat(address.column_letters(F.col("col")), F.col("row").cast("string"))
    out = some.groupBy("sheet").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("__n") <= preview, F.struct("__n", text.alias("a"))))).alias("x"))
    return out.select("sheet", "n", F.transform("x", lambda s: s["a"]).alias("first"), F.greatest(F.col("n") - preview, F.lit(0).cast("long")).alias("more")).orderBy(F.desc("n"), "sheet")


def within(kind: Column, lo: Column, hi: Column, values: Column, num: Column, text: Column) -> Column:
    """Whether a value lies in its domain; open ends bound nothing; ``between`` takes whole numbers only."""
    inside = (lo.isNull() | (num >= lo)) & (hi.isNull() | (num <= hi)) & num.isNotNull()
    return F.coalesce(F.when(kind == "enum", F.array_contains(values, text)).when(kind == "between", inside & (num == F.floor(num))).when(kind == "real_between", inside), F.lit(False))


def dtype_agrees(kind: Column, dtype: Column) -> Column:
    """``between`` needs int, ``real_between`` float or number, ``enum`` any; a missing dtype never agrees."""
    return F.coalesce(F.when(kind == "enum", dtype.isNotNull()).when(kind == "between", dtype == "int").when(kind == "real_between", dtype.isin("float", "number")), F.lit(False))


def leaf_kind(values: Column) -> Column:
    """A leaf whose domain has one value is a constant, else an input; null without a domain, which is an error."""
    return F.when(F.size(values) == 1, "constant").when(values.isNotNull(), "input")


def best_effort_leaf_kinds(leaves: DataFrame) -> DataFrame:
    """``(node, kind)`` of ``leaves(node, vals)``; no row at all if a leaf has no domain."""
    gaps = leaves.agg(F.count_if(F.col("vals").isNull()).alias("gaps"))  # one row
    found = leaves.select("node", leaf_kind(F.col("vals")).alias("kind")).crossJoin(F.broadcast(gaps))
    return found.where("gaps = 0").drop("gaps")


def public(direction: Column, has_input: Column, has_compute: Column) -> Column:
    """Whether a series belongs to the public interface: an input with an input block, an output with a compute."""
    return F.coalesce(F.when(direction == "input", has_input).when(direction == "output", has_compute), F.lit(False))


def domain_text(kind: Column, lo: Column, hi: Column, values: Column) -> Column:
    bound = lambda x: F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(x.cast("string"))
    return F.when(kind == "enum", F.array_join(values, ", ")).when(lo.isNull() & hi.isNull(), "any").when(lo.isNull(), F.concat(F.lit("x ≤ "), bound(hi))).when(hi.isNull(), F.concat(bound(lo), F.lit(" ≤ x"))).otherwise(F.concat(bound(lo), F.lit(" ≤ x ≤ "), bound(hi)))


def overlaid(base: DataFrame, over: DataFrame) -> DataFrame:
    """Domains of both; where both have a series the overlay's."""
    return over.unionByName(base.join(over.select("series_id"), "series_id", "left_anti"))


def catalog(bound: DataFrame, series: DataFrame, domains: DataFrame, cells: DataFrame, direction: str) -> DataFrame:
    """A row for each cell of the series of a direction, with unit, dtype, domain and present value."""
    some = bound.where(F.col("direction") == direction).join(series.select("series_id", "dtype", "record_unit", "attribute_unit"), "series_id")
    text = domain_text(F.col("kind"), F.col("lo"), F.col("hi"), F.col("vals")).alias("domain")
    found = some.join(domains, "series_id", "left").join(cells.select("sheet", "row", "col", "num", "str"), ["sheet", "row", "col"], "left")
    return found.select("series_id", address.rendered(F.col("sheet"), F.col("row"), F.col("col")).alias("address"), "ordinal", F.coalesce("record_unit", "attribute_unit").alias("unit"), "dtype", text, F.coalesce("str", F.col("num").cast("string")).alias("value"))


FINDING = "severity string, code string, series_id string, direction string, message string, address string"


def _finding(df: DataFrame, severity: str, code: str, message: Column, address_: Column | None = None) -> DataFrame:
    return df.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), "series_id", "direction", message.alias("message"), (address_ if address_ is not None else F.lit(None).cast("string")).alias("address"))


def audit(series: DataFrame, resolved: DataFrame, bound: DataFrame, dims: DataFrame, unbound: DataFrame) -> DataFrame:
    """All findings: unresolved and empty series, sparse labels, double binding, unbound cells.

    ``resolved(series_id, row, col, dim_id, key)`` as of :func:`resolve_keys`.
    """
    keys = resolved.groupBy("series_id").agg(F.count("*").alias("n"), F.count("key").alias("n_ok"))
    state = series.select("series_id", "direction").join(keys, "series_id", "left").fillna(0, ["n", "n_ok"])
    public = F.col("direction").isin("input", "output")
    out = _finding(state.where("n > 0 AND n_ok = 0"), "error", "bind_resolution_failed", F.lit("no cell resolves"))
    out = out.unionByName(_finding(state.where((F.col("n") == 0) & public), "warning", "empty_public_series", F.lit("no cell is bound")))
    out = out.unionByName(_finding(state.where("n_ok > 0 AND n_ok < n"), "error", "partial_bind_failure", F.concat(F.col("n_ok").cast("string"), F.lit(" of "), F.col("n").cast("string"), F.lit(" keys resolve"))))
    label = dims.where(F.col("bind_kind").isin("column_header", "row_label") & ~F.coalesce("fill", F.lit(False))).select("series_id", "dim_id")
    sparse = resolved.where("key IS NULL").join(label, ["series_id", "dim_id"]).groupBy("series_id", "dim_id").agg(F.count("*").alias("n")).join(series.select("series_id", "direction"), "series_id")
    out = out.unionByName(_finding(sparse, "error", "sparse_label_without_fill", F.concat("dim_id", F.lit(": "), F.col("n").cast("string"), F.lit(" blank labels"))))
    cell = address.rendered(F.col("sheet"), F.col("row"), F.col("col"))
    twice = bound.where("direction = 'internal'").groupBy("sheet", "row", "col", "direction").agg(F.count_distinct("series_id").alias("n"), F.min("series_id").alias("series_id")).where("n > 1")
    out = out.unionByName(_finding(twice, "error", "duplicate_internal_binding", F.concat(F.col("n").cast("string"), F.lit(" series")), cell))
    loose = unbound.withColumn("series_id", F.lit(None).cast("string")).withColumn("direction", F.lit(None).cast("string"))
    out = out.unionByName(_finding(loose, "error", "unbound_graph_cell", F.lit("no series binds it"), cell))
    return ordered(out)


def ordered(findings: DataFrame) -> DataFrame:
    return findings.orderBy(F.when(F.col("severity") == "error", 0).otherwise(1), "direction", "series_id", "code", "message", "address")


def summary(findings: DataFrame) -> DataFrame:
    return findings.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"), F.coalesce(F.bool_and(F.col("severity") != "error"), F.lit(True)).alias("ok"))


def gate(unbound: DataFrame, policy: str = "error") -> str | None:
    """``off`` looks at nothing, ``warn`` returns a text, ``error`` raises if a cell is unbound."""
    if policy == "off" or unbound.isEmpty():
        return None
    worst = unbound_by_sheet(unbound, 5).limit(20).collect()
    text = "; ".join(f"{r['sheet']}: {r['n']} unbound ({', '.join(r['first'])}{', ...' if r['more'] else ''})" for r in worst)
    if policy == "error":
        raise ValueError(text)
    return text


def compute_clashes(series: DataFrame, keys: DataFrame) -> DataFrame:
    """``(compute, key, n)``: keys that several series of one compute name have; shards must complement each other.

    ``series(series_id, compute)``; a null name is shared by none.  ``keys(series_id, key)``.
    """
    named = series.where("compute IS NOT NULL").select("series_id", "compute")
    return keys.join(named, "series_id").groupBy("compute", "key").agg(F.count_distinct("series_id").alias("n")).where("n > 1")


def internal_index(bound: DataFrame, keys: DataFrame) -> DataFrame:
    """``(address, series_id, ordinal, label)`` of the cells that internal series bind."""
    inner = bound.where("direction = 'internal'")
    named = labels(inner, keys.join(inner.select("series_id").distinct(), "series_id", "left_semi"))
    found = inner.join(named, ["series_id", "row", "col"])
    return found.select(address.rendered(F.col("sheet"), F.col("row"), F.col("col")).alias("address"), "series_id", "ordinal", "label")


def labels(bound: DataFrame, keys: DataFrame) -> DataFrame:
    """``(series_id, row, col, label)``: the series' id with the cell's keys in brackets."""
    joined = keys.groupBy("series_id", "row", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dim_id", "key"))), lambda x: x["key"]), ",").alias("k"))
    found = bound.join(joined, ["series_id", "row", "col"], "left")
    return found.select("series_id", "row", "col", F.when(F.col("k").isNull(), F.col("series_id")).otherwise(F.concat("series_id", F.lit("["), "k", F.lit("]"))).alias("label"))
