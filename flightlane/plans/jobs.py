"""Whole jobs: landed files in, an index table out, with a report of what was taken and rejected.

Each job creates its table if it is absent, with geo fields declared, writes by key so that a second
run changes nothing but the buckets of its keys, and counts in the same action that writes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flightlane.fixed_values import (
    AIRPORT_SCHEMA, FLIGHT_DOCUMENT_SCHEMA, FLIGHT_INDEX_FIELDS, RATING_FIELDS, RATING_FILE_SCHEMA, STATE_FILE_SCHEMA, STATE_INDEX_FIELDS,
)
from flightlane.functions.temporal import ingest_stamp
from flightlane.operators.bulk import write_bulk
from flightlane.operators.documents import bulk_lines, documents, merge_documents, replace_documents
from flightlane.operators.quality import observe_gate, passes
from flightlane.operators.snapshots import SnapshotTable, index_schema
from flightlane.plans import flights, ratings, states
from flightlane.sources.files import read_dimension, read_json

#: Buckets of an index table: only those that a run's keys fall into are written anew.
BUCKETS = 16


def index_table(spark: SparkSession, path: str, incoming: DataFrame, fields: list[str], geo: list[str]) -> SnapshotTable:
    """The table of documents like ``incoming``, with its geo fields declared."""
    schema = incoming.select("id", *fields).schema
    return SnapshotTable(spark, path, index_schema(schema, {name: "geo_point" for name in geo}), BUCKETS)


def _write(spark: SparkSession, path: str, incoming: DataFrame, fields: list[str], order_by: list[str], geo: list[str],
           combine: Callable[..., DataFrame], seen: Observation) -> tuple[SnapshotTable, dict[str, int]]:
    table = index_table(spark, path, incoming, fields, geo)
    table.create_if_absent()
    table.update(incoming, lambda current, new: combine(current, new, fields, order_by))
    return table, seen.get


def index_flights(spark: SparkSession, documents_path: str, airports_path: str, table_path: str, multiline: bool = False) -> tuple[SnapshotTable, dict[str, int]]:
    """Flights of landed documents into the table of flights, replaced by key; the table and its report."""
    seen = Observation()
    found = flights.candidate_flights(read_json(spark, documents_path, FLIGHT_DOCUMENT_SCHEMA, multiline), read_dimension(spark, airports_path, AIRPORT_SCHEMA))
    actions = flights.flight_actions(observe_gate(found, flights.flight_gate(), seen), "flights")
    return _write(spark, table_path, documents(actions), FLIGHT_INDEX_FIELDS, ["order"], ["departure_geopoint", "arrival_geopoint"], replace_documents, seen)


def index_states(spark: SparkSession, states_path: str, table_path: str, multiline: bool = False) -> tuple[SnapshotTable, dict[str, int]]:
    """States of aircraft in the air into the table of states, replaced by key; the table and its report."""
    seen = Observation()
    airborne = observe_gate(read_json(spark, states_path, STATE_FILE_SCHEMA, multiline), states.airborne_gate(), seen)
    actions = states.state_actions(states.state_columns(airborne, STATE_INDEX_FIELDS), "states")
    return _write(spark, table_path, documents(actions), STATE_INDEX_FIELDS, STATE_INDEX_FIELDS, ["geopoint"], replace_documents, seen)


def upsert_ratings(spark: SparkSession, ratings_path: str, table_path: str, run_time: str | None = None, multiline: bool = False) -> tuple[SnapshotTable, dict[str, int]]:
    """Ratings into the table of ratings, field by field; the table and its report."""
    seen = Observation()
    named = ratings.named_ratings(read_json(spark, ratings_path, RATING_FILE_SCHEMA, multiline))
    valid = observe_gate(named, ratings.rating_gate(), seen).withColumn("indexed_at", ingest_stamp(run_time))
    return _write(spark, table_path, documents(ratings.rating_actions(valid, "ratings")), RATING_FIELDS, ["indexed_at"], [], merge_documents, seen)


def send_flights(spark: SparkSession, documents_path: str, airports_path: str, bulk_path: str, run: str, duration: str = "hours",
                 multiline: bool = False) -> dict[str, int]:
    """Flights of landed documents as actions into the bulk sink, once for each ``run``; the run's report.

    With ``duration`` in hours flights replace what has their key; in minutes they are added under random
    ids, so it is the run's name that keeps a second try from adding them again. Flights that the gate
    declines reach the sink as nulls: it counts them as failed in the action that sends the others.
    """
    found = flights.candidate_flights(read_json(spark, documents_path, FLIGHT_DOCUMENT_SCHEMA, multiline), read_dimension(spark, airports_path, AIRPORT_SCHEMA))
    gated = found.withColumn("passed", passes(flights.flight_gate(duration)))
    actions = (flights.flight_actions if duration == "hours" else flights.flight_minutes_actions)(gated, "flights", ["passed"])
    return write_bulk(bulk_lines(actions, F.col("passed")), bulk_path, run)
