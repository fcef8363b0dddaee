"""The index jobs as streams: routed messages, or landed documents, into the keyed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flightlane.fixed_values import (
    AIRPORT_SCHEMA, FLIGHT_INDEX_FIELDS, ISO_MICROS_FORMAT, RATING_FIELDS, RATING_FILE_SCHEMA, STATE_FILE_SCHEMA, STATE_INDEX_FIELDS,
)
from flightlane.operators.documents import documents, merge_documents, replace_documents
from flightlane.operators.messages import unpack_batches
from flightlane.operators.quality import observe_gate
from flightlane.operators.snapshots import SnapshotTable
from flightlane.plans import flights, ratings, states
from flightlane.plans.jobs import index_table
from flightlane.sources.files import read_dimension
from flightlane.streaming.indexing import stream_documents


def stream_states(messages: DataFrame, path: str, order: str = "offset", interval: str | None = None) -> tuple[SnapshotTable, StreamingQuery]:
    """States out of messages (``value``: a record or an array of them) into the table at ``path/table``.

    Of states that share a key the one of the later micro-batch, and within one the one of the higher ``order``, stays.
    """

    def documents_of(batch: DataFrame, seen: Observation) -> DataFrame:
        airborne = observe_gate(unpack_batches(batch, STATE_FILE_SCHEMA, keep=[order]), states.airborne_gate(), seen)
        return documents(states.state_actions(states.state_columns(airborne, STATE_INDEX_FIELDS, [order]), "states", [order]))

    return _stream(messages, path, documents_of, STATE_INDEX_FIELDS, [order], ["geopoint"], replace_documents, interval)


def stream_ratings(messages: DataFrame, path: str, timestamp: str = "timestamp", interval: str | None = None) -> tuple[SnapshotTable, StreamingQuery]:
    """Ratings out of messages into the table at ``path/table``, field by field, stamped with their message's time."""

    def documents_of(batch: DataFrame, seen: Observation) -> DataFrame:
        named = unpack_batches(batch, RATING_FILE_SCHEMA, keep=[timestamp]).select(
            F.col("Airline").alias("airline"), F.col("Stars").alias("stars"), F.date_format(timestamp, ISO_MICROS_FORMAT).alias("indexed_at"))
        return documents(ratings.rating_actions(observe_gate(named, ratings.rating_gate(), seen), "ratings"))

    return _stream(messages, path, documents_of, RATING_FIELDS, ["indexed_at"], [], merge_documents, interval)


def stream_flights(landed: DataFrame, airports_path: str, path: str, interval: str | None = None) -> tuple[SnapshotTable, StreamingQuery]:
    """Flights out of a stream of landed documents into the table at ``path/table``.

    Both ends are looked up in the airports as they are when the micro-batch runs: the dimension is read
    anew for each, so an airport that is added is known from the next micro-batch on.
    """
    spark = landed.sparkSession

    def documents_of(batch: DataFrame, seen: Observation) -> DataFrame:
        found = flights.candidate_flights(batch, read_dimension(spark, airports_path, AIRPORT_SCHEMA))
        return documents(flights.flight_actions(observe_gate(found, flights.flight_gate(), seen), "flights"))

    return _stream(landed, path, documents_of, FLIGHT_INDEX_FIELDS, ["order"], ["departure_geopoint", "arrival_geopoint"], replace_documents, interval)


def _stream(messages: DataFrame, path: str, documents_of: Callable[[DataFrame, Observation], DataFrame], fields: list[str], order_by: list[str],
            geo: list[str], combine: Callable[..., DataFrame], interval: str | None) -> tuple[SnapshotTable, StreamingQuery]:
    spark: SparkSession = messages.sparkSession
    # what the documents look like follows from the plan, which is made over no rows here
    nothing = spark.createDataFrame([], messages.schema)
    table = index_table(spark, f"{path}/table", documents_of(nothing, Observation()), fields, geo)
    table.create_if_absent()
    return table, stream_documents(messages, table, documents_of, lambda current, new: combine(current, new, fields, order_by), path, interval)
