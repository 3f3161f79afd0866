"""The registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from . import ann, embdedup, langid, licenses, mixing, packing, simhash, tokenbin, tokencount, urlfilter
from .common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.domains(table(spark, sf_dir, "labels"))).drop("uid")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(ann.index(vectors), vectors.where("vec_id % 20 = 0"), k=20)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.outcomes_of(table(spark, sf_dir, "labels"))).drop("bad_bound")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_simhash": op1_simhash, "op2_token_ids": op2_token_ids, "op3_language_id": op3_language_id, "op4_token_counts": op4_token_counts, "op5_mixing": op5_mixing, "op6_embedding_dedup": op6_embedding_dedup, "op7_neighbours": op7_neighbours, "op8_url_filter": op8_url_filter, "op9_license_scan": op9_license_scan, "op10_packing": op10_packing}


# Links are decided by the cosine in double precision, components by repeated reach along links.
OP6_SQL = """
WITH RECURSIVE fine AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT DISTINCT a AS node, a AS other FROM links
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
), roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node),
counts AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(r.root, e.vec_id) AS component_id, coalesce(r.root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN roots r ON r.node = e.vec_id LEFT JOIN counts c ON c.node = e.vec_id
"""


def _op8_level(name: str, counts: str) -> str:
    """Common table expressions of one level: its counts with prior mean, prior strength, posterior and bound."""
    low, high = urlfilter.STRENGTH
    return f"""
{name}_counts AS ({counts}),
{name}_fit AS (SELECT coalesce(sum(power(bad - n * m, 2) / n - m * (1 - m)) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0) AS r FROM {name}_counts WHERE n > 1),
{name}_prior AS (SELECT CASE WHEN r <= 1 / ({high} + 1) THEN {high} ELSE greatest({low}, least({high}, 1 / r - 1)) END AS strength FROM {name}_fit),
{name}_beta AS (SELECT name, bad + m * strength AS a, n - bad + (1 - m) * strength AS b FROM {name}_counts, {name}_prior),
{name} AS (SELECT name, a / (a + b) AS mean, a / (a + b) - {urlfilter.Z} * sqrt(a * b / (power(a + b, 2) * (a + b + 1))) AS bound FROM {name}_beta)"""


def _op8_sql() -> str:
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, kind) for kind, h, p in sorted(urlfilter.RULES, key=lambda r: -len(r[1] + r[2]))]
    rule = "CASE " + " ".join(f"WHEN {fit} THEN '{name}'" for fit, name, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fit} THEN '{kind}'" for fit, _, kind in fits) + " END"
    return rf"""
WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), sites AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS site FROM parts),
named AS (
  SELECT *, CASE WHEN regexp_matches(site, '{urlfilter.ADDRESS}') THEN site ELSE regexp_extract(site, '{urlfilter.DOMAIN}') END AS domain,
    CASE WHEN regexp_matches(site, '{urlfilter.ADDRESS}') THEN '{urlfilter.ADDRESSES}' WHEN regexp_extract(site, '{urlfilter.TWO_LABELS}', 1) <> '' THEN regexp_extract(site, '{urlfilter.TWO_LABELS}', 1) ELSE regexp_extract(site, '[^.]*$') END AS suffix FROM sites),
outcomes AS (SELECT doc_id, CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END AS bad FROM labels),
hosted AS (
  SELECT site, domain, suffix, count(*) AS n, sum(bad) AS bad FROM named JOIN outcomes ON doc_id = page_id
  WHERE site <> '' AND bad IS NOT NULL GROUP BY site, domain, suffix
), overall AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1) AS m FROM hosted),
{_op8_level("suffixes", "SELECT suffix AS name, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM hosted, overall GROUP BY suffix")},
{_op8_level("domains", "SELECT domain AS name, sum(n) AS n, sum(bad) AS bad, any_value(s.mean) AS m FROM hosted JOIN suffixes s ON s.name = suffix GROUP BY domain")},
{_op8_level("hosts", "SELECT site AS name, n, bad, d.mean AS m FROM hosted JOIN domains d ON d.name = domain")}
SELECT page_id, p.host, p.path, {rule} AS rule,
  coalesce({verdict}, CASE WHEN coalesce(h.bound, d.bound, s.bound, 0) >= {urlfilter.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM named p LEFT JOIN hosts h ON h.name = p.site LEFT JOIN domains d ON d.name = p.domain LEFT JOIN suffixes s ON s.name = p.suffix
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the operators that SQL can express; the tests hold the others against plain versions."""
    return {"op6_embedding_dedup": OP6_SQL, "op8_url_filter": _op8_sql()}
