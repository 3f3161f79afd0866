"""The SQL of the corpus queries against the queries, on small tables with planted cases."""

import math
import random

import duckdb

from gridloom.llm import queries

URLS = ["http://A.Example.com/de/1?x", "https://x.example.net/en/2", "http://q.net", "http://q.net/", "x://b.org/fr/#a", "nothing", None, "", "http://", "https://notexample.com/de/", "a://b://c/d", "http://a..b/", "http://.net/"]


def both(spark, folder, name, tables):
    """Sorted rows of the query and of its SQL over the same files."""
    found = duckdb.connect()
    for table, df in tables.items():
        path = f"{folder}/{table}.parquet"
        df.coalesce(1).write.parquet(path)
        found.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/*.parquet'")
    got = queries.queries()[name](spark, str(folder))
    columns = sorted(got.columns)
    want = found.execute(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    return sorted(map(repr, map(tuple, got.select(*columns).collect()))), sorted(map(repr, want))


def test_url_filter_sql(spark, tmp_path):
    urls = URLS + [f"http://spam{k % 2}.bad.com/{k}" for k in range(60)] + [f"http://site{k % 5}.good.com/{k}" for k in range(60)] + ["http://new.bad.com/", "http://new.good.com/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(k, int("bad.com" not in (u or "")), 0) for k, u in enumerate(urls) if k % 4] + [(0, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got, want = both(spark, tmp_path, "op8_url_filter", {"pages": pages, "labels": labels})
    assert got == want and sum("'block'" in r for r in got) > 60


def test_url_filter_sql_without_rows(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.b/"), (None, None)], "page_id long, url string")
    got, want = both(spark, tmp_path, "op8_url_filter", {"pages": pages, "labels": spark.createDataFrame([], "doc_id long, quality int, toxic int")})
    assert got == want and len(got) == 2


def test_embedding_dedup_sql(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(60)]
    rows += [(100 + k, [x + 0.1 * rng.gauss(0, 1) for x in rows[k % 7][1]]) for k in range(60)] + [(200 + k, rows[3][1]) for k in range(9)]
    rows += [(300, None), (301, [0.0] * 8), (302, [math.nan] + [1.0] * 7), (303, [None] + [1.0] * 7), (304, [math.inf] + [1.0] * 7), (305, [math.nan] * 8)]
    got, want = both(spark, tmp_path, "op6_embedding_dedup", {"embeddings": spark.createDataFrame(rows, "vec_id long, embedding array<float>")})
    assert got == want and sum("False" in r for r in got) > 40
