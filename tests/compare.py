"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/compare.py [sf_dir] [query ...]

Comparison: row count, column names, and an order-insensitive hash of the
rows with columns sorted by name (floats rounded to 9 significant digits, or
exact with COMPARE_RAW=1).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


RAW = os.environ.get("COMPARE_RAW") == "1"   # hash floats bit for bit


def norm(v):
    if isinstance(v, float):
        return None if v != v else (v if RAW else float(f"{v:.9g}"))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return float(f"{float(v):.9g}")
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"create view {t} as select * from '{p}'")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, osql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:500])
            print(name, "SPARK-ERROR", str(e)[:800], flush=True)
            continue
        t1 = time.time()
        if name not in osql:
            results[name] = ("NO-ORACLE", len(s_rows))
            print(f"{name}: no oracle, {len(s_rows)} rows", flush=True)
            continue
        try:
            rel = con.sql(osql[name])
            o_cols = rel.columns
            o_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("ORACLE-ERROR", str(e)[:500])
            print(name, "ORACLE-ERROR", str(e)[:800], flush=True)
            continue
        sh, sl = digest(s_cols, s_rows)
        oh, ol = digest(o_cols, o_rows)
        ok = (len(s_rows) == len(o_rows) and sorted(s_cols) == sorted(o_cols) and sh == oh)
        results[name] = ("OK" if ok else "MISMATCH", len(s_rows), len(o_rows))
        print(f"{name}: {'OK' if ok else 'MISMATCH'} spark={len(s_rows)} oracle={len(o_rows)} "
              f"({t1 - t0:.1f}s)", flush=True)
        if not ok and verbose:
            if sorted(s_cols) != sorted(o_cols):
                print("  cols spark ", sorted(s_cols))
                print("  cols oracle", sorted(o_cols))
            ss, os_ = set(sl), set(ol)
            print("  only spark :", list(ss - os_)[:3])
            print("  only oracle:", list(os_ - ss)[:3])
    return results


if __name__ == "__main__":
    from tierwell.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    print("SUMMARY", len(res) - len(bad), "ok of", len(res), "bad:", sorted(bad))
