"""Airline ratings: landed records to upserted documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.fixed_values import RATING_FIELDS, RATING_KEY
from flightlane.functions.temporal import ingest_stamp
from flightlane.operators.documents import merge_documents, upsert_actions
from flightlane.operators.quality import complete


def named_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.col("Airline").alias("airline"), F.col("Stars").alias("stars"))


def rating_gate() -> Column:
    return complete(["airline", "stars"])


def valid_ratings(ratings: DataFrame, run_time: str | None = None) -> DataFrame:
    """Renamed, stamped with the run's time, and only with both name and stars."""
    return named_ratings(ratings).where(rating_gate()).withColumn("indexed_at", ingest_stamp(run_time))


def rating_actions(ratings: DataFrame, index: str) -> DataFrame:
    """Upserts keyed by airline and stars: a changed rating becomes a second document."""
    return upsert_actions(ratings, index, RATING_KEY, RATING_FIELDS)


def apply_ratings(current: DataFrame, actions: DataFrame) -> DataFrame:
    """The document table after one run's upserts. The documents of one run under one id are
    equal but for nothing, so the stamp can rank them."""
    return merge_documents(current, actions.select("id", "source.*"), RATING_FIELDS, ["indexed_at"])
