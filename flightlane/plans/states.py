"""Aircraft states: landed records to gated, keyed index documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.fixed_values import STATE_INDEX_FIELDS, STATE_KEY, STATE_REDUCED_FIELDS
from flightlane.functions.temporal import epoch_to_iso, epoch_to_text
from flightlane.functions.text import geopoint, is_false
from flightlane.operators.documents import append_actions, index_actions
from flightlane.operators.quality import complete


# the two time texts are missing exactly when time_position is, and the geo text never is:
# asking for the landed columns lets rows go before anything is derived from them
REDUCED_NEEDS = ["icao24", "origin_country", "time_position", "longitude", "latitude"]
NEEDS = REDUCED_NEEDS + ["altitude", "velocity", "heading", "vertical_rate", "squawk"]


def state_columns(states: DataFrame, fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """The indexed columns of raw states, times as text and the position as geo text."""
    derived = states.withColumns({
        "time_position_date": epoch_to_text("time_position"),
        "geopoint": geopoint("latitude", "longitude"),
        "timestamp": epoch_to_iso("time_position"),
    })
    return derived.select(*fields, *keep or [])


def airborne_gate() -> Column:
    """A complete state of an aircraft in the air."""
    return complete(NEEDS, is_false(F.col("on_ground")))


def valid_states(states: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Complete states of aircraft in the air."""
    return state_columns(states.where(airborne_gate()), STATE_INDEX_FIELDS, keep)


def valid_states_reduced(states: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The variant with fewer columns, on the ground or in the air."""
    return state_columns(states.where(complete(REDUCED_NEEDS)), STATE_REDUCED_FIELDS, keep)


def state_actions(states: DataFrame, index: str, keep: list[str] | None = None) -> DataFrame:
    return index_actions(states, index, STATE_KEY, STATE_INDEX_FIELDS, keep)


def state_reduced_actions(states: DataFrame, index: str) -> DataFrame:
    return append_actions(states, index, STATE_REDUCED_FIELDS)
