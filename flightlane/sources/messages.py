"""Keyed messages, as a topic delivers them or as files hold them.

Both give the columns key, value (text), partition, offset and timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "key STRING, value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"


def topic_options(servers: str, topic: str) -> dict[str, str]:
    """Start at the earliest offset; afterwards the checkpoint owns the offsets."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}


def stream_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Needs Spark's Kafka package on the class path."""
    return decode_messages(spark.readStream.format("kafka").options(**topic_options(servers, topic)).load())


def decode_messages(raw: DataFrame) -> DataFrame:
    """Key and value bytes as UTF-8 text."""
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition", "offset", "timestamp",
    )


def stream_files(
    spark: SparkSession, path: str, schema: str = MESSAGE_SCHEMA, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """The same stream from a folder of files."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(path)


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Write key and value to a topic, each partition from its own executor."""
    (
        messages.select("key", "value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )
