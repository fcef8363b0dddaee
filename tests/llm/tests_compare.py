"""Rows of a query in Spark and of its SQL in DuckDB, in a comparable form."""

import duckdb

TABLES = ("documents", "pages", "labels", "conversations")


def compared(spark, sf_dir, query, sql):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    rows = query(spark, sf_dir)
    assert sorted(rows.columns) == sorted(names)
    return sorted(map(repr, map(tuple, rows.select(*names).collect()))), sorted(map(repr, result.fetchall()))
