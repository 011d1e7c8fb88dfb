"""Run registered queries on Spark and their SQL on DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Compares column names, row counts and the multiset of rows (floats compared
after rounding to 6 places; dates and timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return f"{round(v, 6):.6f}"
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_recs = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_recs = cur.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_recs) == len(d_recs)
    ok_v = ok_cols and _rows(s_cols, s_recs) == _rows(d_cols, d_recs)
    return dict(name=name, ok=ok_cols and ok_n and ok_v, cols=ok_cols, n=(len(s_recs), len(d_recs)),
                values=ok_v, spark_sec=round(t1 - t0, 2), s_cols=s_cols, d_cols=d_cols,
                s_sample=_rows(s_cols, s_recs)[:3], d_sample=_rows(d_cols, d_recs)[:3],
                diff=None if ok_v or not ok_cols else
                (sorted(set(_rows(s_cols, s_recs)) - set(_rows(d_cols, d_recs)))[:3],
                 sorted(set(_rows(d_cols, d_recs)) - set(_rows(s_cols, s_recs)))[:3]))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from tickreport.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name in sorted(qs):
        if only and name not in only:
            continue
        if name not in os_:
            print(f"{name:32s} (no SQL)")
            continue
        try:
            r = compare(spark, con, name, qs[name], os_[name], sf_dir)
        except Exception as e:  # report and continue
            bad += 1
            print(f"{name:32s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        bad += not r["ok"]
        status = "ok" if r["ok"] else "MISMATCH"
        print(f"{name:32s} {status:8s} rows={r['n']} {r['spark_sec']}s")
        if not r["ok"]:
            print("   cols", r["s_cols"], r["d_cols"])
            print("   diff", r["diff"])
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
