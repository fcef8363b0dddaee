"""Packing records into keyed messages, unpacking and routing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flightlane.fixed_values import FIELD_ROUTES, RECORD_KEY_SUFFIX, SOURCE_ROUTES, UNKNOWN_ROUTE
from flightlane.functions.text import record_json
from flightlane.operators.reshape import explode_once, settled

#: Bytes of records in one message at most, unless one record alone has more.
MAX_BYTES = 900_000


def pack_records(rows: DataFrame, prefix: str | Column, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """One message per record, keyed by the prefix of its source."""
    source = F.lit(prefix) if isinstance(prefix, str) else prefix
    return rows.select(F.concat(source, F.lit(RECORD_KEY_SUFFIX)).alias("key"), record_json(columns).alias("value"), *keep or [])


def pack_batches(
    rows: DataFrame, source: str | Column, columns: list[str], batch: int | Column = 0, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Messages with an array of records, keyed by source; no records, no message.

    All rows of a source in one array would have to pass through one task, so every task cuts its
    own rows, in their order, into arrays of at most ``max_bytes``. Every message says which batch (a
    number; later batches have higher ones) it is of, which part of it, and how many parts the batch
    has for its source, so that they land together. Call it before any shuffle, where a repeated task cuts the same rows
    the same way.
    """
    place = F.monotonically_increasing_id()
    prepared = rows.select(
        (F.lit(source) if isinstance(source, str) else source).alias("key"),
        F.spark_partition_id().alias("_task"), place.alias("_place"), F.struct(*columns).alias("_record"),
    )
    size = F.octet_length(F.to_json("_record", {"ignoreNullFields": "false"})) + 1
    within = W.partitionBy("key", "_task").orderBy("_place")
    cut = prepared.withColumn("_cut", F.floor(F.sum(size).over(within) / max_bytes)).groupBy("key", "_task", "_cut").agg(
        F.array_sort(F.collect_list(F.struct("_place", "_record"))).alias("_placed"))
    part = F.concat_ws("-", "_task", "_cut")
    batched = batch if isinstance(batch, Column) else F.lit(batch)
    packed = pack_arrays(cut.select("key", batched.cast("long").alias("batch"), part.alias("part"), F.col("_placed._record").alias("_records")),
                         F.col("key"), "_records", ["batch", "part"])
    parts = cut.groupBy(F.col("key").alias("_key")).agg(F.count("*").alias("parts"))
    return packed.join(parts, F.col("key").eqNullSafe(F.col("_key")), "left").drop("_key")


def pack_arrays(rows: DataFrame, source: str | Column, array: str, keep: list[str] | None = None) -> DataFrame:
    """One message per row that has records in its array, keyed by source; nothing is moved."""
    value = F.to_json(F.col(array), {"ignoreNullFields": "false"})
    return settled(rows, [array]).where(F.size(array) > 0).select(
        (F.lit(source) if isinstance(source, str) else source).alias("key"),
        F.size(array).alias("records"), value.alias("value"), *keep or [],
    )


def parse_payload(messages: DataFrame, schema: str, value: str = "value", out: str = "payload") -> DataFrame:
    """The value decoded by ``schema``, whether it is one JSON text and nothing else, and whether a field has another type.

    Of repeated names the last one counts; a field of another type is null. A text is parsed once: between
    brackets and before a mark of our own, so that it is one record exactly when the mark comes second, and
    what does not fit the schema shows in the corrupt-record column. Only what is no record that way is
    asked again whether it is JSON of another kind: it is, when it is the one element of an array
    in brackets and, whatever brackets it has itself, in double ones.
    """
    wrapped = F.concat(F.lit('{"_wrapped":['), F.col(value), F.lit(',{"_mark":1}]}'))
    parsed = F.from_json(wrapped, f"_wrapped ARRAY<STRUCT<{schema}, _mark INT>>, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    once = settled(messages.withColumn("_parsed", parsed), ["_parsed"])
    items = F.col("_parsed._wrapped")
    record = F.coalesce((F.size(items) == 2) & (F.get(items, F.lit(1))["_mark"] == 1), F.lit(False))
    inside = [F.json_array_length(F.concat(F.lit("[" * n), F.col(value), F.lit("]" * n))) == 1 for n in (1, 2)]
    first = F.get(items, F.lit(0))
    judged = once.withColumns({
        out: F.when(record & first.isNotNull(), first.dropFields("_mark")),
        "is_json": F.when(record, True).otherwise(F.coalesce(inside[0] & inside[1], F.lit(False))),
        "_fits": record & F.col("_parsed._corrupt").isNull(),
    })
    return settled(judged.drop("_parsed"), ["is_json"]).withColumn("mistyped", F.col("is_json") & ~F.col("_fits")).drop("_fits")


def unreadable(value: str) -> Column:
    """Why a text that is not JSON is none; to be asked for rejects only, as it reads them again."""
    return (
        F.when(F.col(value).isNull(), "no text").when(F.trim(value) == "", "empty text")
        .when(F.try_parse_json(F.col(value)).isNotNull(), "more behind the text").otherwise("cut or no JSON")
    )


def split_rejects(parsed: DataFrame, value: str = "value", strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Messages that are JSON, and the rest as they came, each with a reason.

    ``strict`` rejects messages with a field of another type, too.
    """
    good = F.col("is_json") & ~F.col("mistyped") if strict else F.col("is_json")
    reason = F.when(F.col("is_json"), "field of another type").otherwise(unreadable(value))
    return parsed.where(good).drop("is_json", "mistyped"), parsed.where(~good).withColumn("reason", reason).drop("is_json", "mistyped", "payload")


def unpack_batches(messages: DataFrame, schema: str, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """A row per record; a value that is one object counts as an array of one.

    A value that is no JSON gives no row; take such messages with ``split_rejects`` beforehand.
    """
    records = explode_once(messages, F.from_json(F.col(value), f"ARRAY<STRUCT<{schema}>>"), "_record", keep)
    return records.select(*keep or [], "_record.*")


def route_by_key(key: str | Column = "key", routes: dict[str, str] = SOURCE_ROUTES, other: str = UNKNOWN_ROUTE) -> Column:
    """Where a message goes by its key; a key nobody knows, or none, goes to ``other``."""
    source = F.col(key) if isinstance(key, str) else key
    known = F.create_map(*[F.lit(part) for pair in routes.items() for part in pair])
    return F.coalesce(F.element_at(known, source), F.lit(other))


def route_by_field(value: str | Column = "value", routes: dict[str, str] = FIELD_ROUTES) -> Column:
    """Where a record goes by the first listed field it has, null when it has none of them.

    Presence counts, a null value included. The text is parsed once for all fields.
    """
    fields = F.json_object_keys(F.col(value) if isinstance(value, str) else value)
    listed = F.array(*[F.lit(name) for name in routes])
    first = F.get(F.array_intersect(listed, fields), F.lit(0))
    return F.element_at(F.create_map(*[F.lit(part) for pair in routes.items() for part in pair]), first)
