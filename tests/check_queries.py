"""Run registered queries next to their SQL: python tests/check_queries.py [sf] [name ...]."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def session():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName("check").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, decimal.Decimal)):
        return float(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.date() if v.time() == datetime.time() else v
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> str:
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(x) for x in df.collect()])
    if sql is None:
        return f"rows-only {len(got)}"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"MISMATCH columns spark={sorted(df.columns)} sql={sorted(columns)}"
    if got == want:
        return f"ok {len(got)}"
    a, b = set(got), set(want)
    return (f"MISMATCH spark={len(got)} sql={len(want)} only-spark={len(a - b)} only-sql={len(b - a)}\n"
            f"    spark {sorted(a - b, key=repr)[:3]}\n    sql   {sorted(b - a, key=repr)[:3]}")


def main():
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:]
    spark, con = session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            out = compare(spark, con, sf_dir, name, fn, oracles.get(name))
        except Exception as e:  # report and go on with the other queries
            out = f"MISMATCH error {type(e).__name__}: {str(e)[:400]}"
        bad += out.startswith("MISMATCH")
        print(f"{name:32s} {time.time() - t:6.1f}s {out}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
