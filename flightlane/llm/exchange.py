"""Totals by key for blocks of documents.

A block is what one task holds of a batch of documents. It sends each of its distinct 64-bit keys
once, sorted and packed, to the bucket of that key range; the bucket adds up what all blocks sent
and answers every block in the order of its keys. So a key that all documents have costs one entry
per block, and the documents themselves never move.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from flightlane.llm.common import forget, give_back
from flightlane.llm.packing import bucket_cuts, pack, pack_sorted, unpack, unpack_sorted
from flightlane.session import new_path

SENT = "block long, bucket int, keys binary, numbers binary"
ANSWERED = "block long, bucket int, answer binary"
SENT_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("numbers", pa.binary())])
ANSWERED_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("answer", pa.binary())])


def bucket_count(spark: SparkSession) -> int:
    """As many as there are shuffle partitions, which grow with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_table(blocks: DataFrame, name: str) -> DataFrame:
    """One row per block, written to the shared folder in buckets by block.

    What is grouped by block later is read from its bucket, so the blocks are never shuffled.
    """
    spark = blocks.sparkSession
    path = new_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    blocks.write.bucketBy(bucket_count(spark), "block").option("path", path).saveAsTable(table)
    return spark.table(table)


def sent_rows(block: int, keys: np.ndarray, numbers: np.ndarray, buckets: int, bits: int = 64) -> Iterator[tuple]:
    """The rows of SENT for a block's ascending keys, of which the first ``bits`` are sent."""
    cuts = bucket_cuts(keys, buckets)
    for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            yield block, bucket, pack_sorted(keys[a:b] >> np.uint64(64 - bits)), pack(numbers[a:b])


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


#: Gets the bucket's distinct keys, the place of every sent key among them, the block and the number
#: sent with it; gives one answer for each sent key, and any notes on the whole bucket.
Answer = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, bytes | None]]


def exchange(sent: DataFrame, answer: Answer) -> DataFrame:
    """Rows of ANSWERED: for every row sent the packed answers in the order of its keys.

    A row with block -1 holds what the bucket itself notes.
    """

    def of_bucket(group: pa.Table) -> pa.Table:
        forget()
        names, bucket = group["block"].to_pylist(), group["bucket"][0].as_py()
        keys = [unpack_sorted(k.as_py()) for k in group["keys"]]
        lengths = [len(k) for k in keys]
        keys = np.concatenate(keys)
        numbers = np.concatenate([unpack(n.as_py()) for n in group["numbers"]])
        blocks = np.repeat(np.array(names, np.int64), lengths)
        distinct, place = np.unique(keys, return_inverse=True)
        del keys
        answers, note = answer(distinct, place, blocks, numbers)
        out, at = [], 0
        for name, n in zip(names, lengths):
            out.append((name, bucket, pack(answers[at : at + n])))
            at += n
        if note is not None:
            out.append((-1, bucket, note))
        del numbers, distinct, place, blocks, answers
        give_back()
        return pa.Table.from_batches([to_batch(out, ANSWERED_ARROW)])

    return sent.groupBy("bucket").applyInArrow(of_bucket, ANSWERED)


def answers_of(rows: list[tuple[int, bytes]]) -> np.ndarray:
    """A block's answers from all buckets, in the order of its keys."""
    parts = [unpack(data) for _, data in sorted(rows)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
