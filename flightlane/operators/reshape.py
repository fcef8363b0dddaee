"""Explode, flatten, rename, preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_once(
    rows: DataFrame, array: Column, alias: str, keep: list[str] | None = None, pos: str = "_pos"
) -> DataFrame:
    """A row per element of an array, which is computed once.

    A plain explode of a computed column makes the optimizer ask for a non-empty array first,
    and that question computes it (parses the JSON, runs the patterns) a second time.
    """
    exploded = rows.select(*keep or [], F.posexplode_outer(array).alias(pos, alias)).where(F.col(pos).isNotNull())
    return exploded.drop(pos) if pos == "_pos" else exploded


def settled(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with the named columns computed before anything that follows.

    The optimizer moves a filter on a computed column below the computation by repeating it
    there. For parsed text that is the most expensive part of a row done twice; a filter on
    what a generator returns stays where it is.
    """
    others = [name for name in rows.columns if name not in names]
    generated = rows.select(*others, F.explode_outer(F.array(F.struct(*names))).alias("_settled"))
    return generated.select(*[F.col(f"_settled.{name}") if name in names else F.col(name) for name in rows.columns])


def explode_records(documents: DataFrame, array: str = "data", alias: str = "record") -> DataFrame:
    """A row per element of a document's array; null and empty arrays give none."""
    return explode_once(documents, F.col(array), alias)


def flatten(records: DataFrame, paths: dict[str, str], record: str = "record") -> DataFrame:
    """Flat columns for nested paths: output name -> path inside ``record``."""
    return records.select(*[F.col(f"{record}.{path}").alias(name) for name, path in paths.items()])


def role_columns(dimension: DataFrame, role: str, key: str) -> DataFrame:
    """The dimension with ``role_`` before every column but its key."""
    return dimension.withColumnsRenamed({c: f"{role}_{c}" for c in dimension.columns if c != key})


def preview(rows: DataFrame, order_by: list[str | Column], n: int = 5) -> DataFrame:
    """The first n rows of a stated order; kept as one top-n, never a full sort."""
    return rows.orderBy(*order_by).limit(n)
