"""Run a registered Spark query and its DuckDB oracle side by side and compare.

Usage: ``python tests/oracle_harness.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from jobnest.plans.landing import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return v.item()
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = [tuple(_norm(x) for x in r) for r in cur.fetchall()]
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2)}
    res["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        res["match"] = False
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_sorted = sorted((tuple(r[i] for i in order) for r in s_rows), key=_key)
    d_sorted = sorted((tuple(r[d_index[s_cols[i]]] for i in order) for r in d_rows), key=_key)
    res["match"] = s_sorted == d_sorted
    if not res["match"]:
        diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
        res["first_diffs"] = diff
        res["cols"] = [s_cols[i] for i in order]
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from jobnest.session import get_session
    import __spark_entry__ as entry
    spark = get_session("local[8]", 8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls[name], con) if name in sqls else {"name": name, "match": None}
        except Exception as e:  # report and go on
            r = {"name": name, "match": False, "error": repr(e)[:600]}
        bad += r.get("match") is False
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
