"""Parsing, features, durations and text forms of dates and times (UTC session)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightlane.fixed_values import DATE_FORMAT, ISO_MICROS_FORMAT, ISO_MILLIS_FORMAT


def parse_date(text: str | Column) -> Column:
    """Date text to midnight; text that is no date becomes null instead of an error."""
    return F.try_to_timestamp(_column(text), F.lit(DATE_FORMAT))


def parse_instant(text: str | Column) -> Column:
    """ISO-8601 text, with or without an offset, to an instant; bad text becomes null."""
    return F.try_to_timestamp(_column(text))


def epoch_seconds(moment: str | Column) -> Column:
    return F.unix_timestamp(_column(moment))


def duration_hours(start: str | Column, end: str | Column) -> Column:
    """Hours between two moments, rounded half up to one decimal."""
    return F.round((epoch_seconds(end) - epoch_seconds(start)) / 3600, 1)


def zoned_instant(moment: str | Column, zone: str | Column) -> Column:
    """The instant of a local time that a source has stamped as if it were UTC; null without a zone.

    Durations between two of them count real hours where the zones differ.
    """
    return F.to_utc_timestamp(_column(moment), F.col(zone) if isinstance(zone, str) else zone)


def duration_minutes(start: str | Column, end: str | Column) -> Column:
    """Minutes between two moments, not rounded, negative when ``end`` is earlier."""
    return (epoch_seconds(end) - epoch_seconds(start)) / 60


def date_text(moment: str | Column) -> Column:
    return F.date_format(_column(moment), DATE_FORMAT)


def iso_millis(moment: str | Column) -> Column:
    return F.date_format(_column(moment), ISO_MILLIS_FORMAT)


def epoch_to_text(seconds: str | Column) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss``."""
    return F.from_unixtime(_column(seconds))


def epoch_to_iso(seconds: str | Column) -> Column:
    return iso_millis(F.timestamp_seconds(_column(seconds)))


def ingest_stamp(run_time: str | None = None) -> Column:
    """The run's time as ISO text: one value per query, or the one given."""
    moment = F.current_timestamp() if run_time is None else F.lit(run_time).cast("timestamp")
    return F.date_format(moment, ISO_MICROS_FORMAT)


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
