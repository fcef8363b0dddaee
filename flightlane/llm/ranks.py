"""Places of rows within their groups, without a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flightlane.llm.common import small
from flightlane.session import stored


def exact(name: str) -> Column:
    """The column of that very name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    """All named columns are equal in both; null equals null."""
    return reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with their rank (from 0) in the group by ``order`` and the size n of the group.

    Nulls come first and are a group of their own. Rows must not tie; end ``order`` on a column that
    tells them apart. Rows are dealt out by ranges of group and order, so a group with a third of
    all rows fills a third of the tasks; a row's rank is its place in its task less that of the
    group's first row there, plus what earlier tasks hold of the group. That last table has one row
    for each group and task.
    """
    placed = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    placed = stored(placed.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    task = F.shiftrightunsigned("_place", 33)
    runs = placed.groupBy(*group, task.alias("_task")).agg(F.min("_place").alias("_first"), F.count("*").alias("_held"))
    whole, before = W.partitionBy(*group), W.partitionBy(*group).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    starts = stored(runs.select(*group, "_task", "_first", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before"),
                                F.sum("_held").over(whole).alias("n")), "starts")
    kept = small(starts)
    found = placed.join(kept, same(placed, kept, group) & (task == kept["_task"]))
    return found.select(*[placed[c] for c in rows.columns], (placed["_place"] - kept["_first"] + kept["_before"]).alias("rank"), kept["n"])
