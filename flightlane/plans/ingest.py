"""Ingest: pages and payloads to messages, messages to landed objects, landed objects to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.fixed_values import BATCH_KEY, RATING_FILE_SCHEMA, SOURCE_ROUTES, STATE_POSITIONS
from flightlane.operators.messages import pack_arrays, pack_records, route_by_key
from flightlane.operators.reshape import explode_once
from flightlane.sources.html_tables import with_ratings
from flightlane.sources.vectors import with_vectors
from flightlane.streaming.landing import history_per_second, latest_batches, latest_per_source, object_name

RATING_COLUMNS = [part.split()[0] for part in RATING_FILE_SCHEMA.split(", ")]
STATE_COLUMNS = [name for name, _ in STATE_POSITIONS]


def rating_messages(pages: DataFrame, source: str, keep: list[str], html: str = "html") -> DataFrame:
    """One message per fetched page that has ratings, its records in an array."""
    return pack_arrays(with_ratings(pages, "_records", html), source, "_records", keep)


def state_messages(
    payloads: DataFrame, source: str, keep: list[str], cap: int | None = None, value: str = "value"
) -> DataFrame:
    """One message per fetched payload that has state vectors, its records in an array; all of them without a cap."""
    vectors = with_vectors(payloads, value, cap, out="_records")
    return pack_arrays(vectors.withColumnRenamed(value, "_payload"), source, "_records", keep)


def record_messages(pages: DataFrame, payloads: DataFrame, keep: list[str], html: str = "html", value: str = "value") -> DataFrame:
    """One message per record of fetched pages and payloads, keyed by what it comes from.

    ``place`` counts the records of one fetch from 0.
    """
    rated = explode_once(with_ratings(pages, "_records", html), F.col("_records"), "_record", keep, pos="place")
    flown = explode_once(with_vectors(payloads, value, out="_records"), F.col("_records"), "_record", keep, pos="place")
    sent = [pack_records(rows.select(*keep, "place", "_record.*"), route, columns, [*keep, "place"]) for rows, route, columns in (
        (rated, SOURCE_ROUTES["Skytrax"], RATING_COLUMNS), (flown, SOURCE_ROUTES["OpenSky"], STATE_COLUMNS))]
    return sent[0].unionByName(sent[1])


def land_raw(messages: DataFrame, order_by: list[str], timestamp: str = "timestamp", name: str = BATCH_KEY, unique: bool = False) -> DataFrame:
    """Messages of all sources as they came, the last one of each second under its stamped object name."""
    history = history_per_second(messages.withColumn("route", F.lit(name)), "route", order_by, timestamp, unique)
    stamped = F.concat_ws("_", "route", F.col("epoch_second").cast("string"))
    return history.withColumn("object", F.concat(stamped, F.lit(".json")))


def land_latest(messages: DataFrame, order_by: list[str], route: Column | None = None, unique: bool = False) -> DataFrame:
    """Per route the last message, under its fixed object name.

    The routes of the fixed map are few; those of a given column may be many. ``unique`` as in ``latest_by``.
    """
    routed = messages.withColumn("route", route_by_key() if route is None else route)
    return latest_per_source(routed, "route", order_by, unique, few=route is None).withColumn("object", object_name(F.col("route")))


def land_latest_batches(messages: DataFrame, route: Column | None = None, batch: str = "batch") -> DataFrame:
    """Per route all messages of its last batch, under its fixed object name."""
    routed = messages.withColumn("route", route_by_key() if route is None else route)
    return latest_batches(routed, "route", batch).withColumn("object", object_name(F.col("route")))


def land_history(messages: DataFrame, order_by: list[str], timestamp: str = "timestamp", route: Column | None = None, unique: bool = False) -> DataFrame:
    """Per route and second the last message, under its stamped object name. ``unique`` as in ``latest_by``."""
    routed = messages.withColumn("route", route_by_key() if route is None else route)
    history = history_per_second(routed, "route", order_by, timestamp, unique)
    return history.withColumn("object", object_name(F.col("route"), F.col("epoch_second")))
