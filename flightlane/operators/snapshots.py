"""A keyed table whose buckets are rewritten while readers keep seeing a complete version.

Rows are dealt to buckets by a stable hash of their key. A write computes and writes the buckets it
touches into a folder of its own, beside those that are being read, and counts once a commit object of the
next number says which folder holds which bucket; the folders of all other buckets stay as they are.
So a job that dies half-way, or reads the table it changes, harms nobody. (Spark's overwrite of
partitions in place deletes a folder before it moves the new one in, so a driver lost in between would
lose documents.) Everything is written by Spark's own writers and works on any file system they know.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from flightlane.operators.commits import CommitLog, delete_folder
from flightlane.session import stored

BUCKET = "_bucket"


def index_schema(schema: StructType, types: dict[str, str]) -> StructType:
    """The schema with declared index types, such as ``geo_point``, kept as column metadata."""
    unknown = set(types) - set(schema.names)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return StructType([
        StructField(f.name, f.dataType, f.nullable, {**f.metadata, "index_type": types[f.name]} if f.name in types else f.metadata)
        for f in schema.fields
    ])


class SnapshotTable:
    """``buckets`` is fixed for the life of a table: as many as make a bucket's data fit one task well.

    The last ``keep`` versions stay readable; folders that only older ones name are removed by the
    writer, so a read must not take longer than ``keep`` writes.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, buckets: int = 1, key: str = "id", keep: int = 10):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.buckets, self.key, self.keep = buckets, key, max(1, keep)
        self._log = CommitLog(spark, f"{self.path}/commits")

    def version(self) -> int | None:
        """The newest committed version, or None when the table does not exist."""
        commit = self._log.newest()
        return commit["version"] if commit else None

    def has(self, writer: str, batch: int) -> bool:
        """Whether the writer has committed this batch or a later one."""
        return self._done(self._newest(), writer, batch) is not None

    def create_if_absent(self) -> bool:
        """Create the table empty; an existing one is left as it is. Says whether it did."""
        if self._log.numbers():
            return False
        try:
            self._log.create(0, {"version": 0, "buckets": self.buckets, "folders": {}, "writers": {}})
        except FileExistsError:
            return False
        return True

    def read(self) -> DataFrame:
        return self._rows(self._newest(), None)

    def bucket(self, key: Column | None = None) -> Column:
        """The bucket of a key; a null key has one like any other."""
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(self.buckets)).cast("int")

    def replace(self, rows: DataFrame, writer: str | None = None, batch: int | None = None) -> int:
        """Write all buckets anew and commit; returns the version that holds the rows.

        A batch that a writer has committed already changes nothing, but is evaluated, as a stream's
        state expects.
        """
        commit = self._newest(missing={"version": -1, "folders": {}, "writers": {}})
        done = self._done(commit, writer, batch)
        if done is not None:
            self._checked(rows).write.format("noop").mode("overwrite").save()
            return done
        return self._commit(commit, {}, self._written(self._checked(rows), commit), writer, batch)

    def update(self, incoming: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame],
               writer: str | None = None, batch: int | None = None) -> int:
        """Commit what ``combine(current, incoming)`` makes of the buckets that incoming keys fall into.

        ``combine`` gets the rows of those buckets and must keep every row in the bucket of its key. The incoming
        rows are written once, so that what they come from is computed once. A batch that a writer has committed
        already changes nothing. Returns the version that holds it.
        """
        commit = self._newest()
        done = self._done(commit, writer, batch)
        if done is not None:
            return done
        held = stored(incoming.withColumn(BUCKET, self.bucket()), "incoming")
        touched = [r[0] for r in held.select(BUCKET).distinct().collect()]  # of ``buckets`` numbers
        rows = combine(self._rows(commit, touched), held.drop(BUCKET))
        rest = {b: f for b, f in commit["folders"].items() if int(b) not in touched}
        return self._commit(commit, rest, self._written(self._checked(rows), commit) if touched else {}, writer, batch)

    def _newest(self, missing: dict | None = None) -> dict:
        commit = self._log.newest() or missing
        if commit is None:
            raise ValueError(f"no table at {self.path}")
        if commit.get("buckets", self.buckets) != self.buckets:
            raise ValueError(f"the table has {commit['buckets']} buckets, not {self.buckets}")
        return commit

    @staticmethod
    def _done(commit: dict, writer: str | None, batch: int | None) -> int | None:
        last, version = commit["writers"].get(writer, (None, None))
        return version if writer is not None and last is not None and batch <= last else None

    def _rows(self, commit: dict, buckets: list[int] | None) -> DataFrame:
        folders = [f"{self.path}/data/{folder}" for bucket, folder in commit["folders"].items() if buckets is None or int(bucket) in buckets]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def _written(self, rows: DataFrame, commit: dict) -> dict[str, str]:
        """Where each bucket of the rows was written; buckets without rows have no folder."""
        folder = f"v{commit['version'] + 1}-{uuid.uuid4().hex}"
        if self.buckets == 1:
            rows.write.parquet(f"{self.path}/data/{folder}/{BUCKET}=0")
        else:
            rows.withColumn(BUCKET, self.bucket()).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{folder}")
        made = [name for name in self._log.folders(f"{self.path}/data/{folder}") if name.startswith(f"{BUCKET}=")]
        return {name.partition("=")[2]: f"{folder}/{name}" for name in made}

    def _commit(self, before: dict, rest: dict, written: dict, writer: str | None, batch: int | None) -> int:
        version = before["version"] + 1
        writers = before["writers"] | ({writer: [batch, version]} if writer is not None else {})
        try:
            self._log.create(version, {"version": version, "buckets": self.buckets, "folders": rest | written, "writers": writers})
        except FileExistsError:
            raise RuntimeError(f"another writer has committed version {version} of {self.path}") from None
        newest = self._log.numbers()[-1]
        if newest - version >= self.keep:  # the number was free again, as it had been retired meanwhile
            self._log.remove(version)
            raise RuntimeError(f"other writers have committed up to version {newest} of {self.path}")
        self._retire(version - self.keep)
        return version

    def _retire(self, last: int) -> None:
        """Removes the commits up to ``last`` and the folders that no later one names."""
        numbers = self._log.numbers()
        for number, after in zip(numbers, numbers[1:]):
            if number > last:
                break
            for folder in set(self._log.read(number)["folders"].values()) - set(self._log.read(after)["folders"].values()):
                delete_folder(self.spark, f"{self.path}/data/{folder}")
            self._log.remove(number)

    def _checked(self, rows: DataFrame) -> DataFrame:
        declared = {f.name: f.dataType for f in self.schema.fields}
        given = {f.name: f.dataType for f in rows.schema.fields}
        if {n: t.simpleString() for n, t in declared.items()} != {n: t.simpleString() for n, t in given.items()}:
            raise ValueError(f"declared {declared}, given {given}")
        return rows.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in self.schema.fields])
