"""Run registered queries in Spark and their SQL in DuckDB, and compare all values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as registered  # noqa: E402


def connect(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, repr(float(value)))
    return (3, str(value))


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(normal(r[n]) for n in names) for r in df.collect())


def sql_rows(connection, sql):
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, sorted(tuple(normal(r[j]) for j in order) for r in result.fetchall())


def main():
    from flightlane.session import build_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session("local[8]", "compare", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.log.level": "ERROR"})
    connection = connect(sf_dir)
    bad = 0
    for name, run in registered.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            names, got = spark_rows(run(spark, sf_dir))
        except Exception as error:
            print("FAIL ", name, str(error)[:600])
            bad += 1
            continue
        took = time.time() - start
        sql = registered.oracle_sql().get(name)
        if sql is None:
            print(f"rows  {name} {len(got)} {took:.2f}s")
            continue
        try:
            sql_names, want = sql_rows(connection, sql)
        except Exception as error:
            print("SQL   ", name, str(error)[:600])
            bad += 1
            continue
        if (names, got) == (sql_names, want):
            print(f"ok    {name} {len(got)} {took:.2f}s")
        else:
            bad += 1
            print(f"DIFF  {name} {names == sql_names} {len(got)} {len(want)} {names} {sql_names}")
            wanted, found = set(want), set(got)
            print("   spark only", [r for r in got if r not in wanted][:2])
            print("   sql only  ", [r for r in want if r not in found][:2])
    print("bad:", bad)


if __name__ == "__main__":
    main()
