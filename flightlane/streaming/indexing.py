"""Streams into keyed index tables, each micro-batch once, with a report of every one of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flightlane.operators.snapshots import SnapshotTable
from flightlane.session import stored
from flightlane.streaming.landing import start

WRITER = "stream"
REPORT_SCHEMA = "batch BIGINT, succeeded BIGINT, failed BIGINT"


def stream_documents(
    messages: DataFrame, table: SnapshotTable, documents_of: Callable[[DataFrame, Observation], DataFrame],
    combine: Callable[[DataFrame, DataFrame], DataFrame], path: str, interval: str | None = None,
) -> StreamingQuery:
    """Take every micro-batch of ``messages`` through ``documents_of`` into ``table`` by ``combine``.

    ``documents_of`` gates the rows with ``observe_gate`` and the observation it is given. What it makes of
    a micro-batch is written once; that one action counts what passed and what did not, and the report
    stands in ``path/reports`` before the table's commit, which names the micro-batch. So a micro-batch that is
    repeated, whatever it had reached, leaves one commit and one report. (A listener of the query's
    progress would learn the counts later, and not at all when the driver dies in between.)
    """
    spark = messages.sparkSession

    def land(batch: DataFrame, number: int) -> None:
        if table.has(WRITER, number):
            return
        seen = Observation()
        documents = stored(documents_of(batch, seen), "stream-documents")
        counts = seen.get
        report = spark.createDataFrame([(number, counts["succeeded"], counts["failed"])], REPORT_SCHEMA)
        report.coalesce(1).write.mode("overwrite").parquet(f"{path}/reports/batch={number}")
        table.update(documents, combine, WRITER, number)

    return start(messages.writeStream.foreachBatch(land), f"{path}/checkpoint", interval)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """batch, succeeded and failed of every micro-batch of a stream into an index table."""
    return spark.read.schema(REPORT_SCHEMA).parquet(f"{path}/reports").select("batch", "succeeded", "failed")
