"""Compare registered Spark queries with their DuckDB oracle SQL on one scale factor.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column names, exact and rounded value match.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def digest(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i], digits) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()[:16]


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not res["cols_match"]:
        res["cols"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
    else:
        res["exact"] = digest(s_cols, s_rows, None) == digest(d_cols, d_rows, None)
        res["round6"] = digest(s_cols, s_rows, 6) == digest(d_cols, d_rows, 6)
    res["ok"] = res["cols_match"] and res.get("round6", False) and res["spark_rows"] == res["duck_rows"]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from flightlake.session import build_session, local_master
    import __spark_entry__ as entry
    spark = build_session(local_master())
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, sf_dir, name, qs[name], sqls.get(name))
        except Exception as e:  # report and continue
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        if not r.get("ok", r.get("oracle") == "none"):
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
