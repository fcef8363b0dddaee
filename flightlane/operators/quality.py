"""Null drops, completeness gates and their counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def drop_incomplete(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop a row when any of its columns (or of the named ones) is null."""
    return rows.dropna("any", subset=columns)


def complete(required: list[str], *conditions: Column) -> Column:
    """All required columns are present and all conditions hold."""
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in required] + list(conditions))


def passes(gate: Column) -> Column:
    """The gate as plain true or false: an unknown outcome does not pass."""
    return F.coalesce(gate, F.lit(False))


def split_by_gate(rows: DataFrame, gate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that do not; every row is in exactly one of them."""
    return rows.where(gate), rows.where(~passes(gate))


def write_report(rows: DataFrame, gate: Column, by: list[str] | None = None) -> DataFrame:
    """How many rows pass and how many are rejected, over all or per group."""
    return rows.groupBy(*by or []).agg(
        F.count_if(passes(gate)).alias("succeeded"), F.count_if(~passes(gate)).alias("failed")
    )


def observe_gate(rows: DataFrame, gate: Column, observation: Observation) -> DataFrame:
    """The passing rows; the counts arrive with whatever action writes them, without a second scan."""
    counted = rows.observe(
        observation, F.count_if(passes(gate)).alias("succeeded"), F.count_if(~passes(gate)).alias("failed")
    )
    return counted.where(gate)
