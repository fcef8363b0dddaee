"""Left lookups into a dimension and group counts.

They are plain joins: Spark broadcasts a side whose statistics, or whose size once a stage has
run, lie below ``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise, where adaptive
execution splits the tasks of a hot key (``spark.sql.adaptive.skewJoin``). ``strategy`` is a join
hint for callers who know better, such as "merge"; building a plan runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlane.operators.reshape import role_columns


def _hinted(table: DataFrame, strategy: str | None) -> DataFrame:
    return table.hint(strategy) if strategy else table


def left_lookup(rows: DataFrame, dimension: DataFrame, row_key: str, key: str, strategy: str | None = None) -> DataFrame:
    """``rows`` with the dimension's columns, null where the key is unknown.

    A key the dimension holds twice doubles the row. The dimension's key column is dropped.
    """
    looked_up = _hinted(dimension.withColumnRenamed(key, "_key"), strategy)
    return rows.join(looked_up, F.col(row_key) == F.col("_key"), "left").drop("_key")


def role_lookups(rows: DataFrame, dimension: DataFrame, key: str, roles: dict[str, str], strategy: str | None = None) -> DataFrame:
    """One left lookup per role into the same dimension: role name -> key column of ``rows``.

    The dimension's other columns come back once per role, named ``role_column``.
    """
    found = rows
    for role, row_key in roles.items():
        found = left_lookup(found, role_columns(dimension, role, key), row_key, key, strategy)
    return found


def with_group_count(rows: DataFrame, key: str, out: str, strategy: str | None = None) -> DataFrame:
    """Every row with the number of rows of its key; a null key counts 0.

    What ``count(key) over (partition by key)`` gives, but the counting combines before the
    shuffle, and the join back can split the rows of a hot key, which a window cannot.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    counted = rows.join(_hinted(counts, strategy), F.col(key) == F.col("_key"), "left")
    return counted.select(*[F.col(name) for name in rows.columns], F.coalesce("_n", F.lit(0)).alias(out))
