"""Text rules shared by the operators: what a word is, how case is folded, how rows are named."""

from __future__ import annotations

import ctypes
import string
import sys
import types
from collections.abc import Callable

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlane.session import stored

WORD = "[^\\x20\\x09-\\x0D]+"
#: So many rows of keys or hashes are broadcast at most.
BROADCAST_ROWS = 200_000
#: Words whose hashes a task remembers.
WORDS_KEPT = 150_000
FOLD = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; all other characters stay as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text: runs of anything but the six ASCII white-space characters."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def fold_words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8 with A-Z lower-cased; ``bytes.split`` cuts at the same six characters."""
    return text.encode().translate(FOLD).split() if text else []


def free_name(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` does not have."""
    taken = {c.lower() for c in rows.columns}
    while name in taken:
        name = f"_{name}"
    return name


def small(rows: DataFrame) -> DataFrame:
    """A written table of a few narrow columns, to be broadcast where it has BROADCAST_ROWS rows at most
    (some ten megabytes); with more, Spark chooses by its size and shuffles."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def without_keys(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose key is not in the single column of ``gone``; rows with a null key stay."""
    name = free_name(rows, "gone")
    gone = stored(gone.toDF(name).distinct(), "gone-keys")
    return rows.join(small(gone), rows[key] == gone[name], "left_anti")


def crc_remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key gives null."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def _worker_state() -> dict:
    return vars(sys.modules.setdefault("_flightlane_worker", types.ModuleType("_flightlane_worker")))


def kept(name: tuple, make: Callable):
    """What ``make`` gives, made once in the life of a Python worker; only for what can be made anew."""
    state = _worker_state()
    if name not in state:
        state[name] = make()
    return state[name]


def forget() -> None:
    """Drops what earlier stages keep in this Python worker; for tasks that need the memory themselves."""
    state = _worker_state()
    held = [name for name in state if isinstance(name, tuple)]
    for name in held:
        del state[name]
    if held:
        give_back()


def give_back() -> None:
    """Returns what a task has freed to the machine, as a Python worker lives on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class WordHashes(dict):
    """64-bit hashes of words; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value
