"""A corpus from raw documents to token ids: five stages, each over all rows that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flightlane.llm import exact_dedup, jaccard_join, mixing, sentencepiece_fst, toxicity
from flightlane.llm.common import table
from flightlane.session import new_path

#: Target shares of the languages, by tokens.
WEIGHTS = {"en": 0.55, "fr": 0.17, "de": 0.17, "es": 0.11}


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def _exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.dedup(docs)


def _jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates that links connect one document stays."""
    return jaccard_join.keep_one(docs)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, and documents of languages that are short come more than once."""
    return mixing.mix(docs, WEIGHTS, least=1.0)


def _sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text they decode to."""
    return sentencepiece_fst.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded=True)


STAGES = [
    ("toxicity", _toxicity),
    ("exact_dedup", _exact_dedup),
    ("jaccard_join", _jaccard_join),
    ("mixing", _mixing),
    ("sentencepiece", _sentencepiece),
]

#: Compression, fitted rates and the transducer have no SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on the table documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
