"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column/type agreement and value equality
(exact, after sorting rows; floats also compared at 1e-9 relative).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _family(t: str) -> str:
    t = str(t).lower()
    if any(k in t for k in ("int", "long", "short", "byte")):
        return "int"
    if any(k in t for k in ("double", "float", "decimal", "real")):
        return "float"
    if "timestamp" in t or "datetime" in t:
        return "ts"
    if "date" in t:
        return "date"
    if "bool" in t:
        return "bool"
    return "str"


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(round(v, 9)))
    return (1, repr(v))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = [(f.name, _family(f.dataType.simpleString())) for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [(d[0], _family(d[1])) for d in res.description]
    d_rows = [tuple(r) for r in res.fetchall()]
    t2 = time.time()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i][0])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i][0])
    def canon(rows, order):
        out = []
        for r in rows:
            out.append(tuple(r[i] for i in order))
        return sorted(out, key=lambda r: tuple(_key(v) for v in r))
    cs, cd = canon(s_rows, order_s), canon(d_rows, order_d)
    exact = cs == cd
    approx = exact or (len(cs) == len(cd) and all(
        tuple(_key(v) for v in a) == tuple(_key(v) for v in b) for a, b in zip(cs, cd)))
    status = "OK" if (ok_cols and exact) else ("APPROX" if (ok_cols and approx) else "FAIL")
    print(f"{status:6} {name:32} rows spark={len(s_rows)} duck={len(d_rows)} "
          f"cols={'ok' if ok_cols else 'DIFF'} spark={t1-t0:.1f}s duck={t2-t1:.1f}s", flush=True)
    if status == "FAIL":
        if not ok_cols:
            print("   spark cols:", sorted(s_cols))
            print("   duck  cols:", sorted(d_cols))
        diffs = [(a, b) for a, b in zip(cs, cd) if a != b][:3]
        for a, b in diffs:
            print("   spark:", a)
            print("   duck :", b)
    return status


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from feria.session import get_spark
    from feria.registry import ORACLE, QUERIES
    if os.environ.get("PLAIN_SESSION"):
        # what a driver with its own default session would see
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.sql.session.timeZone", os.environ.get("TZ_NAME", "America/New_York"))
                 .config("spark.sql.ansi.enabled", os.environ.get("ANSI", "true"))
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    counts = {}
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        if name not in ORACLE:
            n = fn(spark, sf_dir).count()
            print(f"NOSQL  {name:32} rows spark={n}")
            counts["NOSQL"] = counts.get("NOSQL", 0) + 1
            continue
        try:
            st = compare(spark, con, name, fn, ORACLE[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            st = "ERROR"
            print(f"ERROR  {name:32} {type(e).__name__}: {str(e)[:400]}")
        counts[st] = counts.get(st, 0) + 1
    print(counts)


if __name__ == "__main__":
    main()
