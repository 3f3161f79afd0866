"""Queries over whole tables against their SQL, on small tables with planted cases."""

import re
from collections import Counter

import duckdb

from gridloom.plans import registry


def both(spark, folder, name, tables):
    """Sorted rows of the query and of its SQL over the same files."""
    found = duckdb.connect()
    for table, df in tables.items():
        path = f"{folder}/{table}.parquet"
        df.coalesce(1).write.parquet(path)
        found.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/*.parquet'")
    got = registry.queries()[name](spark, str(folder))
    columns = sorted(got.columns)
    want = found.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    return sorted(map(repr, map(tuple, got.select(*columns).collect()))), sorted(map(repr, want))


def test_function_calls_reads_whole_texts(spark, tmp_path):
    odd = "aß aŉ aǰ aẖ aẗ aẘ aẙ aẚ aﬀ aﬁ aﬂ aﬃ aﬄ aﬅ aﬆ aı aſ aé éa ÀB "
    texts = ["one two SUM(A1) and\nthen INDEX(B2)\tend last ", "Straße offset(x) 日本 a.b_1 c", odd, "", None, "word " * 5000 + "far(1)", "one two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, want = both(spark, tmp_path, "function_calls", {"documents": docs})
    calls, holders = Counter(), Counter()
    for text in texts:
        found = re.findall(r"(?<![A-Z0-9_])([A-Z][A-Z0-9_.]*)\(", (text or "").translate(dict.fromkeys(map(ord, " \t\n"), "(")).upper())
        calls.update(found)
        holders.update(set(found))
    names = {r["function"]: r for r in registry.queries()["function_calls"](spark, str(tmp_path)).collect()}
    assert {f: (r["n_calls"], r["n_formulas"]) for f, r in names.items()} == {f: (n, holders[f]) for f, n in calls.items()}
    assert got == want and names["WORD"]["n_calls"] == 5000 and {"FAR", "STRASSE", "OFFSET", "THEN", "AFFI"} <= set(names) and names["INDEX"]["dynamic"]


def test_whole_tables_reach_the_operators(spark, tmp_path):
    customers = [(k, k * 7 % 5, f"c{k:03}", -1.0) for k in range(120)]  # no balance above 5000
    customer = spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_name string, c_acctbal double")
    suppliers = [(k, k * 7 % 5 if k % 2 else 4) for k in range(100, 140)]
    supplier = spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int")
    lines = [(o, n, 7 * (o % 3), 1.0) for o in range(60) for n in range(1, 2 + o % 5)]  # no quantity above 49, only suppliers that 7 divides
    lineitem = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double")
    names = ("set_diff_keys", "owner_precedence", "owner_contested", "rectangles")
    rows = {}
    for k, name in enumerate(names):
        got, want = both(spark, tmp_path / str(k), name, {"customer": customer, "supplier": supplier, "lineitem": lineitem})
        assert got == want and got
        rows[name] = registry.queries()[name](spark, str(tmp_path / str(k))).collect()

    ours, theirs = {n + 25 * k for k, n, _, _ in customers}, {n + 25 * k for k, n in suppliers}
    assert {(r["k"], r["side"]) for r in rows[names[0]]} == {(k, "left") for k in ours - theirs} | {(k, "right") for k in theirs - ours} and ours & theirs

    held = Counter((n + 25 * (k // 60), ("input", "output", "constant", "internal")[k % 4]) for k, n, _, _ in customers)
    assert {r["address"] for r in rows[names[1]]} == {a for a, _ in held}
    assert {(r["address"], r["direction"]): r["n"] for r in rows[names[2]]} == {x: n for x, n in held.items() if n > 1}

    cells = [(r["sheet"], y, x) for r in rows[names[3]] for y in range(r["r1"], r["r2"] + 1) for x in range(r["c1"], r["c2"] + 1)]
    assert len(cells) == len(set(cells)) and set(cells) == {(s, o % 401, n % 3 + 1) for o, n, s, _ in lines}
