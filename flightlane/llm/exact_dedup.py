"""Exact dedup: group by a 128-bit content hash, compare bytes inside the groups, keep one row of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.llm.common import ascii_lower, free_name, small, whole
from flightlane.session import stored

#: So many 16-byte hashes are broadcast at most; with more, the texts are dealt out by hash and salt.
BROADCAST_HASHES = 200_000
SALTS = 16


def content_hash(text: Column) -> Column:
    """128 bits of the text's bytes."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 hash_of: Callable[[Column], Column] = content_hash, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are after lower-casing A-Z; null counts as empty, so null and
    empty texts form one group. Of equal texts the row with the largest key stays; among rows that
    repeat that key too, one of them stays. A null key is smaller than any other. Other columns of
    ``docs`` are ignored; an empty table gives an empty result.

    Only hashes are shuffled for rows whose hash is unique. Texts that share a hash are grouped by
    (hash, text) after a partial aggregation in each task, so a group that holds a third of all
    rows reaches the shuffle as one row per task.
    """
    texts = docs.select(F.col(key).alias("doc_id"), ascii_lower(whole(text)).alias("norm"))
    digests = stored(texts.select("doc_id", hash_of(F.col("norm")).alias("hash"), F.sha2("norm", 256).alias("text_sha256"),
                                  F.monotonically_increasing_id().alias("row")), "dedup-digests")
    groups = stored(_groups(digests, "hash"), "dedup-groups")
    mixed = stored(_mixed_hashes(texts, groups.where("group_size > 1").select("hash"), hash_of, broadcast_hashes),
                   "dedup-collisions")
    if mixed.isEmpty():
        return _verdict(digests.join(groups, "hash"))
    # different texts share a hash: those rows are told apart by their bytes, all others by hash as before
    held = texts.withColumns({"hash": hash_of(F.col("norm")), "text_sha256": F.sha2("norm", 256),
                              "row": F.monotonically_increasing_id()}).join(mixed, "hash", "left_semi")
    apart = held.join(_groups(held, "hash", "norm"), ["hash", "norm"])
    alike = digests.join(mixed, "hash", "left_anti").join(groups, "hash")
    return _verdict(alike).unionByName(_verdict(apart))


def _groups(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("top"))


def _verdict(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
                       (F.col("row") == F.col("top.row")).alias("kept"), "text_sha256")


def _mixed_hashes(texts: DataFrame, repeated: DataFrame, hash_of, broadcast_hashes: int) -> DataFrame:
    """Hashes under which more than one text stands, by comparing the texts themselves."""
    rows = texts.withColumn("hash", hash_of(F.col("norm")))
    if repeated.count() <= broadcast_hashes:
        rows = rows.join(F.broadcast(repeated), "hash", "left_semi")
    else:
        salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt")
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(
            repeated.select("hash", salts), ["hash", "salt"], "left_semi")
    return rows.groupBy("hash", "norm").agg(F.count("*")).groupBy("hash").count().where("count > 1").select("hash")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, whole and with all their columns.

    Of rows that repeat key and text one stays. Rows with a null key cannot be told from each other
    afterwards and stay. Columns of any name are carried along.
    """
    name, sha = free_name(docs, "dedup_key"), free_name(docs, "dedup_sha")
    rows = exact_groups(docs, key, text).groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    rows = stored(rows.where("doc_id is not null and not (kept and n = 1)").toDF(name, sha, "kept", "n"), "dedup-rows")
    gone, twice = rows.where(~F.col("kept")).select(name, sha), rows.where(F.col("kept")).select(name, sha)
    gone = stored(gone, "dedup-gone")
    left = docs.withColumns({name: F.col(key), sha: F.sha2(ascii_lower(whole(text)), 256)}).join(small(gone), [name, sha], "left_anti")
    if not twice.isEmpty():
        left = left.join(twice, [name, sha], "left_anti").unionByName(left.join(twice, [name, sha], "left_semi").dropDuplicates([name, sha]))
    return left.drop(name, sha)
