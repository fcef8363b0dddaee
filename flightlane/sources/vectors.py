"""Positional arrays inside JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.fixed_values import STATE_POSITIONS, VECTOR_PAYLOAD_SCHEMA
from flightlane.operators.reshape import explode_once


def name_positions(vector: str | Column, positions: list[tuple[str, str]] = STATE_POSITIONS) -> list[Column]:
    """One typed column per position of a text array; short arrays and bad text give null."""
    array = F.col(vector) if isinstance(vector, str) else vector
    return [F.get(array, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(positions)]


def head(array: Column, cap: int | None) -> Column:
    """The first ``cap`` elements of one payload, in its own order; all of them without a cap."""
    return array if cap is None else F.slice(array, 1, cap)


def with_vectors(
    payloads: DataFrame,
    value: str = "value",
    cap: int | None = None,
    positions: list[tuple[str, str]] = STATE_POSITIONS,
    out: str = "vectors",
) -> DataFrame:
    """Payloads with an array of their decoded vectors."""
    states = F.from_json(F.col(value), VECTOR_PAYLOAD_SCHEMA)["states"]
    return payloads.withColumn(out, F.transform(head(states, cap), lambda v: F.struct(*name_positions(v, positions))))


def decode_vectors(
    payloads: DataFrame,
    value: str = "value",
    keep: list[str] | None = None,
    cap: int | None = None,
    positions: list[tuple[str, str]] = STATE_POSITIONS,
) -> DataFrame:
    """A row per vector of each payload; payloads without vectors give no row.

    ``cap`` belongs to one payload, so it is applied before the rows exist.
    """
    states = F.from_json(F.col(value), VECTOR_PAYLOAD_SCHEMA)["states"]
    vectors = explode_once(payloads, head(states, cap), "_vector", keep)
    return vectors.select(*keep or [], *name_positions("_vector", positions))
