"""Bulk sink: action lines sent in chunks by every task, taken over once, with counts of what was sent.

The sink is a Spark data source. Every attempt of a task puts its chunks into a folder of its own, and
the commit names the attempts that count and what they hold in one object, named by the run. So lines of
a task that was lost or ran twice are never read, and a run that is repeated under its name adds nothing.
The target here is a folder that all executors share, by a path or address that Arrow's file systems know.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

#: Bytes of a chunk, as one request of a bulk client would hold; a longer action makes a chunk of its own.
CHUNK_BYTES = 8_000_000
COMMIT_SCHEMA = "run STRING, attempt STRING, chunks INT, succeeded BIGINT, failed BIGINT"
_RUN = re.compile(r"[A-Za-z0-9_.-]+")


@dataclass
class Sent(WriterCommitMessage):
    """What one attempt of a task has put down."""

    run: str
    attempt: str
    chunks: int = 0
    succeeded: int = 0
    failed: int = 0


class BulkWriter(DataSourceArrowWriter):
    """Writes the column ``value``: actions of two lines each, what to do and the document."""

    def __init__(self, path: str, run: str, chunk_bytes: int):
        self.path, self.run, self.chunk_bytes = path, run, chunk_bytes

    def _target(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def committed(self) -> bool:
        store, root = self._target()
        return store.get_file_info(f"{root}/commits/{self.run}.json").type == fs.FileType.File

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        store, root = self._target()
        sent = Sent(self.run, f"{self.run}-{uuid.uuid4().hex}")
        chunk, size = [], 0

        def put() -> None:
            folder = f"{root}/chunks/attempt={sent.attempt}"
            store.create_dir(folder)
            with store.open_output_stream(f"{folder}/{sent.chunks:06d}.ndjson") as file:
                file.write(b"".join(chunk))
            sent.chunks += 1

        for batch in iterator:
            for value in batch.column("value"):
                text = value.as_py()
                if text is None or text.count("\n") != 1:  # no action with its document
                    sent.failed += 1
                    continue
                line = text.encode() + b"\n"
                if chunk and size + len(line) > self.chunk_bytes:
                    put()
                    chunk, size = [], 0
                chunk.append(line)
                size += len(line)
                sent.succeeded += 1
        if chunk:
            put()
        return sent

    def commit(self, messages: list[Sent | None]) -> None:
        """Takes the attempts over; when the run has been before, what it sent then stays."""
        if self.committed():
            return self.abort(messages)
        store, root = self._target()
        for folder in ("chunks/attempt=none", "commits"):
            store.create_dir(f"{root}/{folder}")
        store.open_output_stream(f"{root}/chunks/attempt=none/none.ndjson").close()  # so that there is something to read
        hidden = f"{root}/commits/.{self.run}-{uuid.uuid4().hex}"
        with store.open_output_stream(hidden) as file:
            file.write(b"".join(json.dumps(asdict(m)).encode() + b"\n" for m in messages if m))
        store.move(hidden, f"{root}/commits/{self.run}.json")

    def abort(self, messages: list[Sent | None]) -> None:
        """Removes what the attempts have put down; what a lost one leaves behind is not read."""
        store, root = self._target()
        for message in messages:
            folder = f"{root}/chunks/attempt={message.attempt}" if message and message.chunks else None
            if folder and store.get_file_info(folder).type == fs.FileType.Directory:
                store.delete_dir(folder)


class BulkSink(DataSource):
    """Options: ``path``, ``run`` (letters, digits, ``_.-``; by default a new one) and ``chunkbytes``."""

    @classmethod
    def name(cls) -> str:
        return "bulk"

    def writer(self, schema: StructType, overwrite: bool) -> BulkWriter:
        if overwrite or "value" not in schema.names or schema["value"].dataType != StringType():
            raise ValueError("the bulk sink appends a text column named value")
        run = self.options.get("run") or uuid.uuid4().hex
        if not _RUN.fullmatch(run):
            raise ValueError(f"not the name of a run: {run}")
        return BulkWriter(self.options["path"].rstrip("/"), run, int(self.options.get("chunkbytes", CHUNK_BYTES)))


def write_bulk(lines: DataFrame, path: str, run: str, chunk_bytes: int = CHUNK_BYTES) -> dict[str, int]:
    """Sends ``lines`` (see ``bulk_lines``) as the run of that name; how many actions succeeded and failed.

    A value that is null or not an action with its document fails. A run that was committed before is
    not sent again, and its counts are those of then.
    """
    spark = lines.sparkSession
    if not BulkWriter(path.rstrip("/"), run, chunk_bytes).committed():
        spark.dataSource.register(BulkSink)
        lines.select("value").write.format("bulk").mode("append").options(path=path, run=run, chunkbytes=chunk_bytes).save()
    counts = bulk_reports(spark, path).where(F.col("run") == run).first()
    return {name: counts[name] if counts else 0 for name in ("succeeded", "failed")}


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMMIT_SCHEMA).json(f"{path}/commits")


def bulk_reports(spark: SparkSession, path: str) -> DataFrame:
    """run, succeeded and failed of every run that sent anything."""
    return _commits(spark, path).groupBy("run").agg(F.sum("succeeded").alias("succeeded"), F.sum("failed").alias("failed"))


def read_bulk(spark: SparkSession, path: str) -> DataFrame:
    """run and value, one row per action that was taken over.

    A chunk is read whole; it has CHUNK_BYTES at most, or one action.
    """
    chunks = spark.read.schema("value STRING, attempt STRING").text(f"{path}/chunks", wholetext=True)
    taken = chunks.join(_commits(spark, path).where("chunks > 0").select("run", "attempt"), "attempt")
    return taken.select("run", F.explode(F.regexp_extract_all("value", F.lit("([^\n]*\n[^\n]*)\n"), F.lit(1))).alias("value"))


def sent_documents(sent: DataFrame, fields: StructType, keep: list[str] | None = None) -> DataFrame:
    """op_type, index and id of action lines, and the fields of their documents: what ``bulk_lines`` made text of."""
    parts = F.split("value", "\n")
    head = F.from_json(parts[0], "map<string, struct<_index: string, _id: string>>")
    op_type, target = F.map_keys(head)[0], F.map_values(head)[0]
    whole, update = F.from_json(parts[1], fields), F.from_json(parts[1], StructType().add("doc", fields))["doc"]
    read = sent.select(*keep or [], op_type.alias("op_type"), target["_index"].alias("index"), target["_id"].alias("id"),
                       F.when(op_type == "update", update).otherwise(whole).alias("source"))
    return read.select(*keep or [], "op_type", "index", "id", "source.*")
