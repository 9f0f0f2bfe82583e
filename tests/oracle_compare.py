"""Run registered Spark queries and their DuckDB SQL side by side and compare.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``.
The comparison sorts columns by name, then compares the multiset of rows.
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

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        path += "/*.parquet" if os.path.isdir(path) else ""
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return (2, v.replace(tzinfo=None).isoformat())
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return (3, str(v))


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    body = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, body


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        if name not in sqls:
            results[name] = {"status": "no-oracle"}
            continue
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        cur = con.execute(sqls[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        sc, sb = canon(scols, srows)
        dc, db = canon(dcols, drows)
        ok = sc == dc and sb == db
        res = {"status": "ok" if ok else "MISMATCH", "spark_rows": len(srows),
               "duck_rows": len(drows), "sec": round(t1 - t0, 2)}
        if not ok:
            res["spark_cols"], res["duck_cols"] = sc, dc
            in_spark, in_duck = set(sb), set(db)
            extra = [r for r in sb if r not in in_duck][:3]
            missing = [r for r in db if r not in in_spark][:3]
            res["spark_only"], res["duck_only"] = extra, missing
        results[name] = res
        if verbose:
            print(name, res, flush=True)
    return results


if __name__ == "__main__":
    from riverbed.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in out.items() if v["status"] == "MISMATCH"]
    print("MISMATCHES:", bad)
