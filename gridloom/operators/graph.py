"""Graph operators over ``edges(parent, child)``: the parent depends on the child.

Reachability and layering are loops of joins.  What a round finds is written as a table of its own,
so the next round's plan has the size of the first's, however deep the graph is, and no round is
lost with an executor.  The nodes found so far are the tables of all rounds, read at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import shared


def closure(edges: DataFrame, seeds: DataFrame, downstream: bool = True) -> DataFrame:
    """``(node)``: what depends on the seeds (or, upstream, what they depend on), seeds included.

    Cycles end by themselves: a node is followed once.
    """
    a, b = ("child", "parent") if downstream else ("parent", "child")
    read = edges.sparkSession.read
    links = edges.select(F.col(a).alias("node"), F.col(b).alias("next")).where("node IS NOT NULL AND next IS NOT NULL")
    start = seeds.select(F.col(seeds.columns[0]).alias("node")).where("node IS NOT NULL").distinct()
    paths = [shared.write(start, "front")]
    while not (front := read.schema(start.schema).parquet(paths[-1])).isEmpty():
        found = read.schema(start.schema).parquet(*paths)
        new = front.join(links, "node").select(F.col("next").alias("node")).distinct().join(found, "node", "left_anti")
        paths.append(shared.write(new, "front"))
    return read.schema(start.schema).parquet(*paths)


def layers(nodes: DataFrame, edges: DataFrame) -> DataFrame | None:
    """``(node, layer)``: length of the longest path of dependencies below a node; None if there is a cycle.

    Nodes carry how many of their dependencies are open.  A round joins only the newest layer's
    nodes to the edges and takes those off; nodes left with none are the next layer.  Edges whose
    child is no node do not count.
    """
    read = edges.sparkSession.read
    every = nodes.select(F.col(nodes.columns[0]).alias("node")).distinct()
    known = edges.select("parent", "child").distinct().join(every.withColumnRenamed("node", "child"), "child", "left_semi")
    links = read.schema(known.schema).parquet(shared.write(known, "links"))
    counts = links.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("open"))
    state = every.join(counts, "node", "left").select("node", F.coalesce("open", F.lit(0).cast("long")).alias("open"))
    schema = every.withColumn("layer", F.lit(0)).schema
    state = read.schema(state.schema).parquet(shared.write(state, "open"))
    paths: list[str] = []
    while not state.isEmpty():
        paths.append(shared.write(state.where("open = 0").select("node", F.lit(len(paths)).alias("layer")), "layer"))
        front = read.schema(schema).parquet(paths[-1])
        if front.isEmpty():
            return None
        freed = links.join(front.select(F.col("node").alias("child")), "child").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("freed"))
        rest = state.where("open > 0").join(freed, "node", "left").select("node", (F.col("open") - F.coalesce("freed", F.lit(0).cast("long"))).alias("open"))
        state = read.schema(state.schema).parquet(shared.write(rest, "open"))
    return read.schema(schema).parquet(*paths) if paths else every.withColumn("layer", F.lit(0))


def roles(nodes: DataFrame, targets: DataFrame, outputs: DataFrame, inputs: DataFrame, constants: DataFrame) -> DataFrame:
    """``(node, role)`` with precedence target, output, input, constant, internal."""
    ranked = [(targets, 0), (outputs, 1), (inputs, 2), (constants, 3)]
    some = None
    for df, rank in ranked:
        part = df.select(F.col(df.columns[0]).alias("node"), F.lit(rank).alias("rank"))
        some = part if some is None else some.unionByName(part)
    best = some.groupBy("node").agg(F.min("rank").alias("rank"))
    names = F.array(*(F.lit(x) for x in ("target", "output", "input", "constant")))
    return nodes.join(best, "node", "left").select("node", F.coalesce(F.get(names, F.col("rank")), F.lit("internal")).alias("role"))


def audit_role(formula: Column, classified: Column, known: Column) -> Column:
    """Role of a child in an audit: missing, formula, its leaf class, or leaf."""
    return F.when(~known, "missing").when(formula.isNotNull(), "formula").otherwise(F.coalesce(classified, F.lit("leaf")))


def topology(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(sheet, n_nodes, n_edges)``; an edge counts for the sheet of what is depended on."""
    n = nodes.groupBy("sheet").agg(F.count("*").alias("n_nodes"))
    e = edges.join(nodes.select(F.col("node").alias("child"), "sheet"), "child").groupBy("sheet").agg(F.count("*").alias("n_edges"))
    return n.join(e, "sheet", "full_outer").select("sheet", F.coalesce("n_nodes", F.lit(0)).alias("n_nodes"), F.coalesce("n_edges", F.lit(0)).alias("n_edges"))


def summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of counts: nodes, edges, leaves (nodes that depend on nothing) and edges with a cause noted.

    ``edges`` may have a column ``causes``; null and empty lists note none.  No rows: zeros.
    """
    names = nodes.select("node").distinct()
    leaves = names.join(edges.select(F.col("parent").alias("node")), "node", "left_anti")
    cause = F.coalesce(F.size("causes") > 0, F.lit(False)) if "causes" in edges.columns else F.lit(False)
    kinds = names.select(F.lit("node").alias("kind")).unionByName(leaves.select(F.lit("leaf").alias("kind"))).unionByName(edges.select(F.when(cause, "caused").otherwise("edge").alias("kind")))
    count = lambda *kind: F.count_if(F.col("kind").isin(*kind))
    return kinds.agg(count("node").alias("node_count"), count("edge", "caused").alias("edge_count"), count("leaf").alias("leaf_count"), count("caused").alias("provenance_edge_count"))


def within_layers(nodes: DataFrame, edges: DataFrame, sweeps: int = 2) -> DataFrame:
    """``(node, layer, rank)``: nodes ordered in their layers by the mean rank of their neighbours.

    ``nodes(node, layer, position)`` start in order of position, ``edges(source, target)`` point to
    higher layers.  A sweep goes up, ordering each layer by what its nodes read, then down by what
    reads them; nodes without such neighbours count with their own rank, ties stay in order.  A
    layer is ordered in one task, so this is for graphs that :func:`layout_enabled` lets through.
    """
    spark = nodes.sparkSession
    rank = lambda *order: (F.row_number().over(Window.partitionBy("layer").orderBy(*order)) - 1).alias("rank")
    now = nodes.select("node", "layer", rank("position", "node"))
    schema = now.schema
    top = nodes.agg(F.max("layer")).first()[0]
    if top is None:
        return now
    links = edges.select("source", "target").distinct()
    now = spark.read.schema(schema).parquet(shared.write(now, "ranks"))
    for _ in range(sweeps):
        for layer, own, other in [(k, "target", "source") for k in range(1, top + 1)] + [(k, "source", "target") for k in range(top - 1, -1, -1)]:
            of = now.select(F.col("node").alias(other), F.col("rank").alias("r"))
            middle = links.join(of, other).groupBy(F.col(own).alias("node")).agg(F.avg("r").alias("m"))
            here = now.where(F.col("layer") == layer).join(middle, "node", "left").select("node", "layer", rank(F.coalesce("m", "rank"), "rank"))
            now = spark.read.schema(schema).parquet(shared.write(now.where(F.col("layer") != layer).unionByName(here), "ranks"))
    return now


def unknown_ends(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with an end that is no node."""
    known = nodes.select("node")
    ends = edges.select("parent", "child", F.explode(F.array("parent", "child")).alias("node"))
    return ends.join(known, "node", "left_anti").select("parent", "child").distinct()


def visible(nodes: DataFrame, edges: DataFrame, sheet: str | None = None, role: str | None = None, text: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes that pass the filters, and the edges of which both ends do."""
    keep = F.lit(True)
    if sheet is not None:
        keep &= F.col("sheet") == sheet
    if role is not None:
        keep &= F.col("role") == role
    if text:
        keep &= F.contains(F.lower(F.concat_ws(" ", "node", "formula")), F.lit(text.lower()))
    some = nodes.where(keep)
    ends = some.select("node")
    left = edges.join(ends.withColumnRenamed("node", "parent"), "parent", "left_semi").join(ends.withColumnRenamed("node", "child"), "child", "left_semi")
    return some, left.select(*edges.columns)


def producers(edges: DataFrame) -> DataFrame:
    """``(source, target)``: distinct edges, turned to run from what is read to what reads it."""
    return edges.select(F.col("child").alias("source"), F.col("parent").alias("target")).distinct()


def without_blank(nodes: DataFrame, blank: DataFrame) -> DataFrame:
    """Nodes ``(sheet, row, col)`` outside the rectangles ``(sheet, r1, c1, r2, c2)``; the join is on the sheet."""
    inside = (nodes["sheet"] == blank["sheet"]) & nodes["row"].between(blank["r1"], blank["r2"]) & nodes["col"].between(blank["c1"], blank["c2"])
    return nodes.join(blank, inside, "left_anti")


def dynamic_edges(refs: DataFrame, domains: DataFrame) -> DataFrame:
    """Edges of an offset whose steps come from a cell with a domain.

    ``refs(parent, sheet, row, col, control)``, ``domains(control, step)``: one edge for each value
    of the domain, its cause noted.  References whose control has no domain are returned with a
    null child.
    """
    found = refs.join(domains, "control", "left")
    child = F.when(F.col("step").isNotNull(), F.struct("sheet", "row", (F.col("col") + F.col("step")).alias("col")))
    return found.select("parent", child.alias("child"), F.array(F.lit("dynamic_offset")).alias("causes")).distinct()


def clusters(nodes: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of ``groups(cluster, node)`` that are no nodes, and nodes in more than one cluster."""
    unknown = groups.join(nodes.select("node"), "node", "left_anti")
    several = groups.groupBy("node").agg(F.count_distinct("cluster").alias("n")).where("n > 1")
    return unknown, several


def payload(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One JSON text per element, nodes and edges, for a graph viewer."""
    n = nodes.select(F.to_json(F.struct(F.lit("nodes").alias("group"), F.struct(F.col("node").alias("id"), "role", "sheet").alias("data"))).alias("element"))
    e = producers(edges).select(F.to_json(F.struct(F.lit("edges").alias("group"), F.struct("source", "target").alias("data"))).alias("element"))
    return n.unionByName(e)


def centred(nodes: DataFrame) -> DataFrame:
    """``(node, role, x)`` moved so that each role's mean is zero."""
    mean = nodes.groupBy("role").agg(F.avg("x").alias("m"))
    return nodes.join(mean, "role").select("node", "role", (F.col("x") - F.col("m")).alias("x"))


def layout_enabled(n_nodes: int, n_edges: int, most_nodes: int = 10_000, most_edges: int = 50_000) -> bool:
    return n_nodes <= most_nodes and n_edges <= most_edges
