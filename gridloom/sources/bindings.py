"""Series-binding shards (YAML files) as tables: concepts, series, dimensions, domains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CONCEPTS = "concept string, name string, dtype string, sdmx_concept string"
SERIES = "series_id string, sheet string, data_ranges array<string>, layout string, direction string, dtype string, compute_name string, key array<string>, record_unit string, attribute_unit string, notes string"
DIMS = "series_id string, dim_id string, concept string, scope string, bind_kind string, header_row int, label_column string, value string, read string, normalize string, fill boolean, include_in_record boolean"
DOMAINS = "series_id string, kind string, lo double, hi double, vals array<string>"

DIRECTIONS = ("inputs", "outputs", "internals", "constants")


def _domain(series_id: str, domain: dict) -> tuple | None:
    """Both spellings of a domain: ``{enum: [..]}`` and ``{type: enum, values: [..]}``."""
    kind = domain.get("type") or domain.get("kind") or next((k for k in ("enum", "between", "real_between") if k in domain), None)
    if kind is None:
        return None
    body = domain.get(kind, domain)
    if kind == "enum":
        values = body if isinstance(body, list) else body.get("values", [])
        return series_id, kind, None, None, [str(v) for v in values]
    lo, hi = body if isinstance(body, list) else (body.get("min", body.get("lo")), body.get("max", body.get("hi")))
    return series_id, kind, None if lo is None else float(lo), None if hi is None else float(hi), None


def parse(texts: list[str]) -> dict[str, list[tuple]]:
    """Rows of the four tables from the texts of shards; a series may come in several shards."""
    import yaml

    out: dict[str, list[tuple]] = {"concepts": [], "series": [], "dims": [], "domains": []}
    for text in texts:
        shard = yaml.safe_load(text) or {}
        for c in shard.get("concept_scheme", shard.get("concepts", [])) or []:
            if isinstance(c, dict):
                out["concepts"].append((c.get("id"), c.get("name"), c.get("dtype"), c.get("sdmx_concept")))
        for s in shard.get("series", []) or []:
            measure, where = s.get("measure") or {}, s.get("data_range", s.get("data_ranges", []))
            own = s.get("input") or s.get("output") or s.get("internal") or s.get("constant") or {}
            direction = s.get("direction") or next((d for d in ("input", "output", "internal", "constant") if d in s), None)
            compute = (own.get("compute") or {}) if isinstance(own, dict) else {}
            unit = (s.get("attributes") or {}).get("UNIT_MEASURE") if isinstance(s.get("attributes"), dict) else None
            out["series"].append((s.get("id"), s.get("sheet"), [where] if isinstance(where, str) else list(where), s.get("layout"), direction, measure.get("dtype"), compute.get("name") if isinstance(compute, dict) else compute, [str(k) for k in s.get("key", []) or []], None, str(unit) if unit is not None else None, s.get("notes")))
            for d in s.get("dimensions", []) or []:
                bind = d.get("bind") or {}
                out["dims"].append((s.get("id"), d.get("id"), d.get("concept"), d.get("scope"), bind.get("kind"), bind.get("header_row"), bind.get("label_column"), None if bind.get("value") is None else str(bind["value"]), bind.get("read"), bind.get("normalize"), bool(bind.get("fill", False)), bool(d.get("include_in_record", True))))
            domain = s.get("domain") or (own.get("domain") if isinstance(own, dict) else None)
            if domain and (row := _domain(s.get("id"), domain)):
                out["domains"].append(row)
    return out


def load(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of all ``*.bindings.yaml`` files at ``path``; empty tables if there is none.

    Shards are small texts of settings, a few for each workbook, and are parsed on the driver.
    """
    from pyspark.errors import AnalysisException

    try:
        texts = [r["value"] for r in spark.read.text(path, wholetext=True, pathGlobFilter="*.bindings.yaml").collect()]
    except AnalysisException:
        texts = []
    rows = parse(texts)
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in (("concepts", CONCEPTS), ("series", SERIES), ("dims", DIMS), ("domains", DOMAINS))}
