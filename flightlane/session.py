"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # a literal 'Z' is printed behind local time, so local time has to be UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "flightlane", **settings) -> SparkSession:
    """A session with the runtime settings; ``master`` stays unset on a cluster."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    setting = "spark.checkpoint.dir"
    named = spark.conf.get(setting, None) or context.getConf().get(setting) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="flightlane-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: computed once however often they
    are used, and still there when an executor is lost."""
    path = new_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def spread(rows: DataFrame, per_core: int = 2) -> DataFrame:
    """``rows`` over some tasks for each core, where a table of few bytes would be read by fewer.

    For narrow rows of which each makes much work: Spark cuts its input by bytes.
    """
    tasks = per_core * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(tasks) if rows.rdd.getNumPartitions() < tasks else rows


def object_store_settings(endpoint: str, path_style: bool = True) -> dict[str, str]:
    """Hadoop settings to read and write ``s3a://`` paths of an S3-compatible store in place.

    Credentials are left to the store's own provider chain.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }
