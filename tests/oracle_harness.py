"""Run a registered job in Spark and its oracle SQL in DuckDB, compare order-insensitively.

Usage: python tests/oracle_harness.py [sf_dir] [job ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.isdir(path):          # a table written by Spark: a folder of part files
            path = f"{path}/*.parquet"
        elif not os.path.exists(path):
            continue
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v))   # exact: both engines must produce the same double
    if isinstance(v, decimal.Decimal):
        return (1, str(v))
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (3, str(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return (4, v.isoformat())
    return (5, str(v))


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    out.sort()
    return [columns[i] for i in order], out


def compare(spark, name: str, sf_dir: str, con=None):
    import __spark_entry__ as entry

    job = entry.queries()[name]
    sql = entry.oracle_sql().get(name)
    t0 = time.time()
    df = job(spark, sf_dir)
    spark_cols = df.columns
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    spark_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    result = {"name": name, "spark_rows": len(spark_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        result["ok"] = None
        return result
    con = con or duck(sf_dir)
    t0 = time.time()
    rel = con.sql(sql)
    duck_cols = rel.columns
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    duck_rows = rel.fetchall()
    result["duck_sec"] = round(time.time() - t0, 2)
    result["duck_rows"] = len(duck_rows)
    sc, sr = rows_of(spark_cols, spark_rows)
    dc, dr = rows_of(duck_cols, duck_rows)
    result["cols_ok"] = sc == dc
    result["rows_ok"] = sr == dr
    result["types"] = {c: (spark_types.get(c), duck_types.get(c)) for c in sorted(set(sc) | set(dc))}
    result["ok"] = result["cols_ok"] and result["rows_ok"] and len(sr) == len(dr)
    if not result["ok"]:
        if not result["cols_ok"]:
            result["cols"] = (sc, dc)
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        result["only_spark"] = diff_s
        result["only_duck"] = diff_d
    return result


def main(argv):
    from leadscope.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry

    names = names or list(entry.queries())
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": f"{type(e).__name__}: {str(e)[:800]}"}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
