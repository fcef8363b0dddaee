"""JSON documents and headerless CSV, always read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_json(spark: SparkSession, path: str | list[str], schema: str, multiline: bool = False) -> DataFrame:
    """JSON objects, or arrays of objects with one row per element.

    ``multiline=True`` takes a whole file as one value, which one task has to parse; data of
    any size belongs in files with one object or array per line, which split.
    Any path Spark can open will do, ``s3a://`` included; nothing is copied to local disk.
    """
    return spark.read.schema(schema).option("multiLine", str(multiline).lower()).json(path)


def read_dimension(spark: SparkSession, path: str, schema: str, columns: list[str] | None = None) -> DataFrame:
    """A headerless CSV dimension; ``\\N`` stays the two characters it is."""
    table = spark.read.schema(schema).csv(path)
    return table.select(*columns) if columns else table
