"""Text, key and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"

# every kind of white space, not just the blank that trim() removes
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGES, "")


def digits_to_int(text: Column) -> Column:
    """Text of digits only as an int, anything else as null."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def is_false(flag: Column) -> Column:
    """True for a boolean false or the text false in any case; true, null and other text, such as 0 or no, fail."""
    return F.coalesce(F.lower(strip(flag.cast("string"))) == "false", F.lit(False))


def geopoint(latitude: str, longitude: str) -> Column:
    """``lat,lon`` text; never null, a missing part is left out."""
    return F.concat_ws(",", F.col(latitude), F.col(longitude))


def natural_key(columns: list[str]) -> Column:
    """Key text of several columns. Gate the rows first: a null part would vanish."""
    return F.concat_ws("_", *[F.col(name) for name in columns])


def record_json(columns: list[str | Column]) -> Column:
    """One record as JSON text that keeps null fields."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def has_field(json: Column, name: str) -> Column:
    """Whether a JSON object has the field at all; a null value counts as present."""
    return F.coalesce(F.array_contains(F.json_object_keys(json), name), F.lit(False))


def decode_entities(texts: Column) -> Column:
    """An array of texts with HTML entities decoded, or null when none of them has any.

    Only arrays with an ampersand in them go through Python (in Arrow batches); for all
    others it is handed a null.
    """
    return _unescape()(F.when(F.exists(texts, lambda text: text.contains("&")), texts))


def _unescape():
    import pandas as pd

    # nested on purpose: shipped by value, executors need not have this package
    def decode(arrays: pd.Series) -> pd.Series:
        from html import unescape

        def each(texts):
            return [None if text is None else unescape(text) for text in texts]

        return arrays.map(each, na_action="ignore")

    decode.__annotations__ = {"arrays": pd.Series, "return": pd.Series}
    return F.pandas_udf(decode, "array<string>")
