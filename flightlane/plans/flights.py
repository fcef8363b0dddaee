"""Flights: nested documents to enriched, gated, keyed index documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.fixed_values import FLIGHT_INDEX_FIELDS, FLIGHT_KEY, FLIGHT_PATHS
from flightlane.functions import temporal as t
from flightlane.functions.text import geopoint
from flightlane.operators.documents import append_actions, index_actions
from flightlane.operators.lookup import role_lookups
from flightlane.operators.quality import complete, drop_incomplete
from flightlane.operators.reshape import explode_records, flatten, settled

ROLES = {"departure": "departure_iata", "arrival": "arrival_iata"}
COORDINATES = [f"{role}_{part}" for role in ROLES for part in ("latitude", "longitude")]
# ranks flights that share a key: all that tells two of them apart, so the winner is fixed
FLIGHT_ORDER = ["departure_scheduled", "arrival_scheduled", "airline_name", "flight_iata", "departure_iata",
                "arrival_iata", "departure_geopoint", "arrival_geopoint", "departure_timezone", "arrival_timezone"]


def flat_flights(documents: DataFrame) -> DataFrame:
    """Flat rows of text for every flight in every document."""
    return flatten(explode_records(documents), FLIGHT_PATHS)


def typed_flights(flat: DataFrame) -> DataFrame:
    """Dates and times parsed; a flight with any gap, unreadable times included, is gone."""
    times = {
        "flight_date": t.parse_date("flight_date"),
        "departure_scheduled": t.parse_instant("departure_scheduled"),
        "arrival_scheduled": t.parse_instant("arrival_scheduled"),
    }
    return drop_incomplete(settled(flat.withColumns(times), list(times)))


def located_flights(flights: DataFrame, airports: DataFrame, strategy: str | None = None) -> DataFrame:
    """Coordinates of both ends; an unknown airport leaves them null and the geo text empty."""
    coordinates = airports.select("iata", "latitude", "longitude")
    located = role_lookups(flights, coordinates, "iata", ROLES, strategy)
    return located.withColumns({f"{role}_geopoint": geopoint(f"{role}_latitude", f"{role}_longitude") for role in ROLES})


def timed_flights(flights: DataFrame) -> DataFrame:
    """Calendar features and durations, then the times as text."""
    start, end = "departure_scheduled", "arrival_scheduled"
    features = flights.withColumns({
        "departure_day": F.dayofweek(start), "arrival_day": F.dayofweek(end),
        "departure_hour": F.hour(start), "arrival_hour": F.hour(end),
        "departure_unix": t.epoch_seconds(start), "arrival_unix": t.epoch_seconds(end),
        "flight_duration_hours": t.duration_hours(start, end),
        "flight_duration_minutes": t.duration_minutes(start, end),
    })
    return features.withColumns({start: t.iso_millis(start), end: t.iso_millis(end), "flight_date": t.date_text("flight_date")})


def candidate_flights(documents: DataFrame, airports: DataFrame, strategy: str | None = None) -> DataFrame:
    """Flights with all that the gate and the index need."""
    return timed_flights(located_flights(typed_flights(flat_flights(documents)), airports, strategy))


def flight_gate(duration: str = "hours") -> Column:
    """What a candidate needs to be indexed.

    The gate asks for the coordinates only: the flat columns have no nulls after the drop, and
    what is derived from them has none either. In hours, the rounded duration must be positive;
    in minutes, negative durations stay.
    """
    return complete(COORDINATES, *[F.col("flight_duration_hours") > 0] * (duration == "hours"))


def valid_flights(documents: DataFrame, airports: DataFrame, duration: str = "hours", strategy: str | None = None) -> DataFrame:
    """Flights that may be indexed."""
    return candidate_flights(documents, airports, strategy).where(flight_gate(duration))


def flight_actions(flights: DataFrame, index: str, keep: list[str] | None = None) -> DataFrame:
    """Replace-by-key actions; number, date and hour make the key, so airlines can collide."""
    order = F.struct(*FLIGHT_ORDER).alias("order")
    return index_actions(flights.withColumn("order", order), index, FLIGHT_KEY, FLIGHT_INDEX_FIELDS, ["order", *(keep or [])])


def flight_minutes_actions(flights: DataFrame, index: str, keep: list[str] | None = None) -> DataFrame:
    """Append actions of the variant with minutes and random ids."""
    fields = ["flight_duration_minutes" if f == "flight_duration_hours" else f for f in FLIGHT_INDEX_FIELDS]
    return append_actions(flights, index, fields, keep)
