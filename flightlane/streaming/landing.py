"""Landing messages: the latest per source, the history per second, or routed batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from flightlane.operators.commits import delete_folder
from flightlane.operators.documents import latest_by
from flightlane.operators.messages import route_by_field, unreadable
from flightlane.operators.reshape import settled
from flightlane.operators.snapshots import SnapshotTable
from flightlane.session import stored


def object_name(route: Column, second: Column | None = None) -> Column:
    """Name of the landed object: fixed per route, or stamped with the epoch second."""
    parts = [route, F.lit("data")] + ([second.cast("string")] if second is not None else [])
    return F.concat(F.concat_ws("_", *parts), F.lit(".json"))


def latest_per_source(messages: DataFrame, source: str, order_by: list[str], unique: bool = False, few: bool = False) -> DataFrame:
    """The last message of every source: each one replaces the one before. See ``latest_by``."""
    return latest_by(messages, [source], order_by, unique=unique, few=few)


def batch_parts(messages: DataFrame, source: str, batch: str = "batch", part: str = "part", parts: str = "parts") -> DataFrame:
    """source, batch, got and parts: how many different parts of each batch are there, and how many it has.

    Narrow columns only, added up in each task first; a part that came twice counts once.
    """
    seen = messages.groupBy(source, batch, part).agg(F.max(parts).alias("_parts"))
    return seen.groupBy(source, batch).agg(F.count("*").alias("got"), F.max("_parts").alias("parts"))


def latest_batches(messages: DataFrame, source: str, batch: str = "batch", part: str = "part", parts: str = "parts") -> DataFrame:
    """All messages of the last batch of every source that has arrived with all its parts, each part once.

    A batch of which parts are missing counts as not there, so the one before it stays; a source without
    a whole batch gives nothing. Batches are numbers, and 10 follows 9.
    """
    whole = batch_parts(messages, source, batch, part, parts).where("got = parts")
    last = whole.groupBy(F.col(source).alias("_source")).agg(F.max(F.col(batch).cast("long")).alias("_batch"))
    found = messages.join(last, F.col(source).eqNullSafe(F.col("_source")) & (F.col(batch).cast("long") == F.col("_batch")), "left_semi")
    return found.dropDuplicates([source, batch, part])


def history_per_second(messages: DataFrame, source: str, order_by: list[str], timestamp: str = "timestamp", unique: bool = False) -> DataFrame:
    """All messages under (source, epoch second); in the same second the later one stays."""
    stamped = messages.withColumn("epoch_second", F.unix_timestamp(timestamp))
    return latest_by(stamped, [source, "epoch_second"], order_by, unique=unique)


def land_objects(landed: DataFrame, path: str) -> None:
    """Write the values of a small landing, one folder per object name: objects that come
    again are replaced, all others stay. Read one with ``object_path``."""
    writer = landed.select("object", "value").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("object").text(path)


def object_path(path: str, name: str) -> str:
    return f"{path}/object={name}"


def _by_folder(rows: DataFrame, source: str) -> DataFrame:
    """With a folder name that is safe for any key; the key itself stays a column as it is."""
    return rows.withColumn("folder", F.concat(F.lit("k"), F.coalesce(F.hex(F.encode(F.col(source).cast("string"), "UTF-8")), F.lit("_none"))))


def land_history(history: DataFrame, path: str, source: str) -> None:
    """Append to a table with one folder per source; keys and values are written as they are."""
    _by_folder(history, source).write.mode("append").partitionBy("folder").parquet(path)


def read_history(spark, path: str, source: str, order_by: list[str]) -> DataFrame:
    """The landed history; a second that two runs have landed is settled here."""
    landed = spark.read.parquet(path)
    return latest_by(landed.drop("folder", "batch"), [source, "epoch_second"], order_by)


def stream_latest(
    messages: DataFrame, table: SnapshotTable, source: str, order_by: list[str], interval: str | None = None
) -> StreamingQuery:
    """Keep ``table``, keyed by the source, at the last message per source.

    The table is the state: each micro-batch is reduced to its last message per source, and the
    buckets those sources fall into are combined with it, the higher ``order_by`` winning, so late messages
    change nothing. A commit names the micro-batch, so a repeated one changes nothing, and readers see whole
    micro-batches only. Sources without new messages are neither read nor written, but for those
    that share a bucket. Without ``interval`` it takes what is there and stops.
    """
    if table.key != source:
        raise ValueError(f"the table is keyed by {table.key}, not {source}")

    def newer(current: DataFrame, incoming: DataFrame) -> DataFrame:
        return latest_by(current.unionByName(incoming), [source], order_by).select(*table.schema.names)

    def land(batch: DataFrame, number: int) -> None:
        table.update(latest_per_source(batch, source, order_by), newer, writer="stream", batch=number)

    return start(messages.writeStream.foreachBatch(land), f"{table.path}/checkpoint", interval)


def latest_schema(messages: DataFrame, source: str, order_by: list[str]) -> StructType:
    """Columns a table for ``stream_latest`` has to have."""
    return messages.select(source, *[name for name in messages.columns if name != source]).schema


def stream_routes(
    messages: DataFrame, path: str, checkpoint: str, route: Column | None = None, interval: str | None = None, rejects: str | None = None
) -> StreamingQuery:
    """Land records by the fields they have: one folder per micro-batch and route.

    Records that fit no route, unreadable ones among them, go as they came and with a reason to
    ``rejects``, one folder per micro-batch, or are dropped without it. With it the micro-batch is written first, so
    that it is computed once. A repeated batch overwrites its own folders.
    """
    routed = settled(messages.withColumn("route", route_by_field() if route is None else route), ["route"])

    def land(batch: DataFrame, number: int) -> None:
        batch = stored(batch, "routed") if rejects else batch
        batch.where("route is not null").write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch={number}")
        if rejects:
            keys = F.json_object_keys("value")
            reason = F.when(keys.isNotNull(), "no field of a route").otherwise(unreadable("value"))
            batch.where("route is null").drop("route").withColumn("reason", reason).write.mode("overwrite").parquet(f"{rejects}/batch={number}")

    return start(routed.writeStream.foreachBatch(land), checkpoint, interval)


def stream_objects(messages: DataFrame, path: str, order_by: list[str], checkpoint: str, route: Column, interval: str | None = None) -> StreamingQuery:
    """Land the last message of every route in each micro-batch as the object of fixed name that the
    index jobs read; later batches replace the objects of earlier ones, repeated ones their own.

    For messages that are a fetch each. Those of batches in many parts go through ``stream_batches``.
    """
    if "parts" in messages.columns:
        raise ValueError("messages that are parts of batches land with stream_batches")
    routed = messages.withColumn("route", route)

    def land(batch: DataFrame, number: int) -> None:
        last = latest_per_source(batch, "route", order_by)
        land_objects(last.withColumn("object", object_name(F.col("route"))), path)

    return start(routed.writeStream.foreachBatch(land), checkpoint, interval)


#: What ``stream_batches`` remembers of each route: the batch that stands in the lake.
LANDED_SCHEMA = StructType([StructField("route", StringType()), StructField("batch", LongType())])


def stream_batches(
    messages: DataFrame, path: str, checkpoint: str, route: Column, patience: int = 100, buckets: int = 1, interval: str | None = None
) -> StreamingQuery:
    """Land batches of packed messages as objects of fixed names once all their parts have arrived.

    Parts may come in any order, over any number of micro-batches, and more than once. Below ``path``:

    - ``lake``: per route the object of its last whole batch. While a batch is incomplete the one before
      it stays, and batches older than what has landed are passed over;
    - ``landed``: which batch that is, in a table whose commits name the micro-batch;
    - ``waiting/n``: the parts that still wait after micro-batch n, with the micro-batch they came in, from which the
      next one goes on. It is a table and not a key's state, so a source of any size is spread over tasks;
    - ``rejects``: per micro-batch the parts that will not land, with the reason: their batch was still incomplete
      ``patience`` micro-batches after its first part, or when a later batch of the route was whole.

    A repeated micro-batch writes again what it wrote before.
    """
    spark = messages.sparkSession
    routed = messages.withColumn("route", route)
    landed = SnapshotTable(spark, f"{path}/landed", LANDED_SCHEMA, buckets, "route")
    landed.create_if_absent()
    schema = routed.schema.add("_came", LongType())

    def land(batch: DataFrame, number: int) -> None:
        held = stored(batch.withColumn("_came", F.lit(number).cast("long")), "arrived")
        if number > 0:
            held = held.unionByName(spark.read.schema(schema).parquet(f"{path}/waiting/{number - 1}"))
        counted = stored(_open_batches(held, landed.read()), "open-batches")
        whole = stored(counted.where("got = parts").groupBy("route").agg(F.max("batch").alias("batch")), "whole-batches")
        found = _of_batches(held, whole).dropDuplicates(["route", "batch", "part"])
        land_objects(found.withColumn("object", object_name(F.col("route"))), f"{path}/lake")
        rest = counted.where("got < parts").join(whole.withColumnRenamed("batch", "_last"), "route", "left")
        judged = rest.withColumn("reason", F.when(F.col("batch") < F.col("_last"), "a later batch is whole").when(
            F.col("first") <= number - patience, "still incomplete"))
        gone = judged.where("reason is not null").select("route", "batch", "reason")
        held.join(gone, ["route", "batch"]).drop("_came").write.mode("overwrite").parquet(f"{path}/rejects/batch={number}")
        _of_batches(held, judged.where("reason is null").select("route", "batch")).write.mode("overwrite").parquet(f"{path}/waiting/{number}")
        landed.update(whole, lambda current, new: latest_by(current.unionByName(new), ["route"], ["batch"]), writer="stream", batch=number)
        # a repeat of this micro-batch starts from the one before, none from earlier ones
        delete_folder(spark, f"{path}/waiting/{number - 2}")

    return start(routed.writeStream.foreachBatch(land), checkpoint, interval)


def _open_batches(held: DataFrame, landed: DataFrame) -> DataFrame:
    """route, batch, got, parts and the first micro-batch of batches that are later than what has landed."""
    known = landed.select(F.col("route").alias("_route"), F.col("batch").alias("_batch"))
    counted = batch_parts(held, "route").join(held.groupBy("route", "batch").agg(F.min("_came").alias("first")), ["route", "batch"])
    return counted.join(known, F.col("route") == F.col("_route"), "left").where("_batch is null or batch > _batch").drop("_route", "_batch")


def _of_batches(held: DataFrame, batches: DataFrame) -> DataFrame:
    return held.join(batches, ["route", "batch"], "left_semi")


def read_routes(spark, path: str, latest_only: bool = False) -> DataFrame:
    """The landed records of all batches, or for every route those of its last batch only."""
    landed = spark.read.parquet(path)
    if not latest_only:
        return landed
    # batch and route are folder names: a handful of values, found without reading records
    last = landed.groupBy("route").agg(F.max("batch").alias("batch"))
    return landed.join(last, ["route", "batch"], "left_semi")


def stream_history(
    messages: DataFrame, path: str, source: str, order_by: list[str], checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Land the history batch by batch; read it with ``read_history``."""

    def land(batch: DataFrame, number: int) -> None:
        history = history_per_second(batch, source, order_by)
        _by_folder(history, source).write.mode("overwrite").partitionBy("folder").parquet(f"{path}/batch={number}")

    return start(messages.writeStream.foreachBatch(land), checkpoint, interval)


def start(writer, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Start a stream; without an interval it takes what is there and stops."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
