"""Token-ID output: every shard is one compressed file that holds a wavelet matrix of its tokens."""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flightlane.llm.common import FOLD, kept
from flightlane.llm.packing import pack, unpack
from flightlane.session import new_path

MAGIC = b"WVMX0001"
#: Bits between two entries of the rank directory.
STRIDE = 1024
#: A shard ends with the document that reaches so many tokens.
SHARD_TOKENS = 4_000_000
#: Words a worker remembers from one task to the next; the words before those are found again, too.
WORDS_KEPT = 800_000
END_ID = 1
#: A character for private use; its bytes begin no other, so its ids stand for it alone.
MARK = "\ue000".encode()


class WaveletMatrix:
    """A sequence of tokens as one bit plane per level, the highest bit first.

    Each level keeps the order of the one above, zeros before ones, so a token is found by following
    its bits down, and all its occurrences end up next to each other behind the last level.
    """

    def __init__(self, n: int, levels: int, zeros: list[int], planes, ranks):
        self.n, self.levels, self.zeros = n, levels, zeros
        self._packed, self._ranks, self._bits = planes, ranks, {}

    @classmethod
    def build(cls, tokens: np.ndarray) -> WaveletMatrix:
        n, levels = len(tokens), max(1, int(tokens.max()).bit_length() if len(tokens) else 1)
        planes, ranks, zeros = [], [], []
        for level in range(levels):
            ones = ((tokens >> (levels - 1 - level)) & 1).astype(bool)
            plane = np.packbits(ones, bitorder="little")
            planes.append(plane)
            whole_strides = np.pad(plane, (0, -len(plane) % (STRIDE // 8))).reshape(-1, STRIDE // 8)
            before = np.cumsum(np.bitwise_count(whole_strides).sum(1, dtype=np.uint32), dtype=np.uint32)
            ranks.append(np.concatenate([np.zeros(1, np.uint32), before[:-1]]))
            low = np.compress(~ones, tokens)
            zeros.append(len(low))
            tokens = np.concatenate([low, tokens.take(np.flatnonzero(ones))])
        return cls(n, levels, zeros, planes, ranks)

    def bits(self, level: int) -> np.ndarray:
        """A level's plane of packed bits, unpacked from the file when first asked for."""
        if level not in self._bits:
            plane = self._packed[level]
            self._bits[level] = np.frombuffer(zstandard.ZstdDecompressor().decompress(plane), np.uint8) if isinstance(plane, (bytes, memoryview)) else plane
        return self._bits[level]

    def ones(self, level: int, i: int) -> int:
        """How many ones a level has before place ``i``."""
        if i <= 0:
            return 0
        block = min(i // STRIDE, len(self._ranks[level]) - 1)
        at = block * STRIDE
        here = self.bits(level)[at // 8 : (i + 7) // 8]
        return int(self._ranks[level][block]) + int(np.unpackbits(here, bitorder="little")[: i - at].sum())

    def _down(self, level: int, bit: int, i: int) -> int:
        ones = self.ones(level, i)
        return self.zeros[level] + ones if bit else i - ones

    def access(self, i: int) -> int:
        """The token at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for level in range(self.levels):
            bit = int(self.bits(level)[i // 8] >> (i % 8)) & 1
            token = 2 * token + bit
            i = self._down(level, bit, i)
        return token

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the occurrences of a token among the first ``i`` lie behind the last level."""
        if token >> self.levels:
            return 0, 0
        a, b = 0, i
        for level in range(self.levels):
            bit = token >> (self.levels - 1 - level) & 1
            a, b = self._down(level, bit, a), self._down(level, bit, b)
        return a, b

    def rank(self, token: int, i: int) -> int:
        """How often a token stands before place ``i``."""
        a, b = self._range(token, min(max(i, 0), self.n))
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The place of the occurrence number ``k`` of a token, counted from 0."""
        a, b = self._range(token, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for level in reversed(range(self.levels)):
            bit = token >> (self.levels - 1 - level) & 1
            wanted = at - self.zeros[level] if bit else at
            low, high = 0, len(self._ranks[level]) - 1
            while low < high:  # the last stride with no more than ``wanted`` such bits before it
                middle = (low + high + 1) // 2
                before = int(self._ranks[level][middle])
                if (before if bit else middle * STRIDE - before) <= wanted:
                    low = middle
                else:
                    high = middle - 1
            before = int(self._ranks[level][low])
            wanted -= before if bit else low * STRIDE - before
            inside = np.unpackbits(self.bits(level)[low * STRIDE // 8 : (low + 1) * STRIDE // 8], bitorder="little")
            at = low * STRIDE + int(np.flatnonzero(inside == bit)[wanted])
        return at

    def tokens(self) -> np.ndarray:
        """The whole sequence, from the last level up."""
        values = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in reversed(range(self.levels)):
            ones = np.unpackbits(self.bits(level), count=self.n, bitorder="little").astype(bool)
            above = np.empty_like(values)
            above[np.flatnonzero(~ones)] = values[: self.zeros[level]]
            above[np.flatnonzero(ones)] = values[self.zeros[level] :] | values.dtype.type(1 << (self.levels - 1 - level))
            values = above
        return values


def shard_bytes(names: np.ndarray, missing: np.ndarray, lengths: np.ndarray, tokens: np.ndarray) -> bytes:
    """A shard file: magic, length of the header, header, sections. The header says where each section is."""
    matrix = WaveletMatrix.build(tokens)
    packer = zstandard.ZstdCompressor(level=1)
    sections = [pack(names), pack(missing.astype(np.uint8)), pack(lengths)]
    sections += [packer.compress(plane.tobytes()) for plane in matrix._packed] + [pack(r) for r in matrix._ranks]
    header = json.dumps({"tokens": matrix.n, "docs": len(names), "levels": matrix.levels, "zeros": matrix.zeros,
                         "sections": [len(s) for s in sections]}).encode()
    return b"".join([MAGIC, struct.pack("<Q", len(header)), header, *sections])


def open_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Keys, token counts and tokens of a shard file."""
    if bytes(data[:8]) != MAGIC:
        raise ValueError("not a token shard")
    (size,) = struct.unpack_from("<Q", data, 8)
    header, at = json.loads(bytes(data[16 : 16 + size])), 16 + size
    sections = []
    for length in header["sections"]:
        sections.append(bytes(data[at : at + length]))
        at += length
    if at != len(data):
        raise ValueError("the shard is cut short")
    levels = header["levels"]
    names, missing, lengths = (unpack(s) for s in sections[:3])
    matrix = WaveletMatrix(header["tokens"], levels, header["zeros"], sections[3 : 3 + levels], [unpack(s) for s in sections[3 + levels :]])
    return [None if m else n for n, m in zip(names.tolist(), missing.tolist())], lengths, matrix


class WordIds(dict):
    """Token ids by word, as bytes. Words are asked for together; what is long unused is forgotten."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.older: dict[bytes, bytes] = {}
        self.lower_cases = self._lower_cases()
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32

    def _lower_cases(self) -> bool:
        """Whether the tokenizer lower-cases, cuts off points and takes a word of letters as one."""
        ids = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in ("Wort.", "wort", ".", "2,", "2", ",")]
        alone = [t.id for t in self.tokenizer.model.tokenize("wort")]
        return ids[0] == ids[1] + ids[2] and ids[3] == ids[4] + ids[5] and ids[1] == alone

    def learn(self, words: set[bytes]) -> None:
        if len(self) > WORDS_KEPT:
            self.older = dict(self)
            self.clear()
        self.update((w, self.older[w]) for w in words if w in self.older)
        tokenize, kind, code, together = self.tokenizer.model.tokenize, self.kind, np.dtype(self.kind).char, []
        for word in words:
            if word in self:
                continue
            if self.lower_cases and word.isalpha() and word.islower():
                # ASCII letters are one word to the model as they stand
                self[word] = array(code, [t.id for t in tokenize(word.decode())]).tobytes()
            elif MARK in word or b"<|" in word:
                self[word] = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, kind).tobytes()
            else:
                together.append(word)
        for at in range(0, len(together), 20_000):
            self._encode_together(together[at : at + 20_000])

    def _encode_together(self, words: list[bytes]) -> None:
        """Encodes words as texts of a hundred words with a mark behind each, and cuts the ids at the marks."""
        texts = [b"".join(w + b" " + MARK + b" " for w in words[i : i + 100]).decode() for i in range(0, len(words), 100)]
        mark = np.array(self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids, self.kind)
        ids = np.concatenate([np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ends = ids[len(mark) - 1 :] == mark[-1]
        for i, m in enumerate(mark[:-1]):
            ends &= ids[i : len(ids) - len(mark) + 1 + i] == m
        ends, width = np.flatnonzero(ends), ids.itemsize
        data, starts = ids.tobytes(), np.concatenate([[0], ends[:-1] + len(mark)])
        self.update((w, data[a:b]) for w, a, b in zip(words, (starts * width).tolist(), (ends * width).tolist(), strict=True))


#: A point or comma that ends a word behind a letter or digit. U+0130 is none of them, as its lower case
#: ends in a mark that the tokenizer takes together with the point.
_TAIL = re.compile(r"[.,](?<=[^\W_\u0130][.,])(?=[ \t-\r]|\Z)")


def _words(text: str, ids: WordIds) -> list[bytes]:
    """The words of a text, lower-cased and with a last point or comma apart, so that many are alike.

    Only where that changes nothing: the tokenizer lower-cases and cuts between letters or digits and
    other characters, the text has no name of a special token, and its accents are joined to their
    letters before and after.
    """
    if ids.lower_cases and "<|" not in text:
        if text.isascii():
            return _TAIL.sub(r" \g<0>", text).encode().translate(FOLD).split()
        lower = text.encode().translate(FOLD).decode()
        if unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", lower):
            return _TAIL.sub(r" \g<0>", lower).encode().split()
    return text.encode().split()


def encoded(texts: list[str | None], ids: WordIds, end_id: int) -> Iterator[np.ndarray]:
    """The ids of each text and the end id.

    The tokenizer drops white space and no token reaches over any, so a text's ids are those of its
    words one after the other; each different word is encoded once.
    """
    end = np.array([end_id], ids.kind).tobytes()
    at = 0
    while at < len(texts):
        held, some = 0, []
        while at < len(texts) and held < 4_000_000:
            some.append(_words(texts[at] or "", ids))
            held += len(texts[at] or "")
            at += 1
        found = [list(map(ids.get, words)) for words in some]
        new = [[i for i, known in enumerate(got) if known is None] for got in found]
        ids.learn({words[i] for words, places in zip(some, new) for i in places})
        for words, got, places in zip(some, found, new):
            for i in places:
                got[i] = ids[words[i]]
            yield np.frombuffer(b"".join(got) + end, ids.kind)


def _filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (pa.fs.LocalFileSystem(), folder)


def _write_shards(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    files, path = _filesystem(folder)
    files.create_dir(path, recursive=True)
    partition, number = TaskContext.get().partitionId(), 0
    words = kept(("words", hash(tokenizer)), lambda: WordIds(tokenizer))
    names, parts, held = [], [], 0

    def flush() -> pa.RecordBatch:
        nonlocal number, names, parts, held
        name = f"{partition:08d}-{number:06d}-{uuid.uuid4().hex}.wvm"
        data = shard_bytes(np.array([n or 0 for n in names], np.int64), np.array([n is None for n in names]),
                           np.array([len(p) for p in parts], np.uint32), np.concatenate(parts))
        with files.open_output_stream(f"{path}/{name}", compression=None) as out:
            out.write(data)
        row = {"part": [partition], "number": [number], "file": [name], "tokens": [held]}
        number, names, parts, held = number + 1, [], [], 0
        return pa.RecordBatch.from_pydict(row)

    for batch in batches:
        texts = batch.column(1).to_pylist()
        for name, ids in zip(batch.column(0).to_pylist(), encoded(texts, words, end_id)):
            names.append(name)
            parts.append(ids)
            held += len(ids)
            if held >= shard_tokens:
                yield flush()
    if names:
        yield flush()


def write_token_shards(docs: DataFrame, folder: str, tokenizer_file: str, key: str = "doc_id", text: str = "text",
                       end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes shard files in ascending order of the key and returns their list: part, number, file, tokens, start.

    ``folder`` is one that all executors share. Every attempt of a task writes files of its own; the
    list, written last, names those that count, so a lost or repeated task leaves no wrong token.
    Null texts are the end id alone; null keys come first; rows that repeat a key stand side by side.
    Documents are dealt out by ranges of key and text hash, so a repeated key fills no single task.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        tokenizer = file.read()  # a vocabulary of fixed size, sent to the executors with the function
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    listed = ordered.mapInArrow(lambda batches: _write_shards(batches, f"{folder}/shards", tokenizer, end_id, shard_tokens),
                                "part long, number long, file string, tokens long")
    listed.write.parquet(f"{folder}/list")
    return shard_list(spark, folder)


def shard_list(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of a folder with the number of tokens before each."""
    listed = spark.read.schema("part long, number long, file string, tokens long").parquet(f"{folder}/list")
    # one row for each task that wrote
    parts = listed.groupBy("part").agg(F.sum("tokens").alias("t")).select(
        "part", (F.sum("t").over(W.orderBy("part")) - F.col("t")).alias("before"))
    within = F.sum("tokens").over(W.partitionBy("part").orderBy("number")) - F.col("tokens")
    return listed.withColumn("within", within).join(parts, "part").select(
        "part", "number", "file", "tokens", (F.col("before") + F.col("within")).alias("start"))


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, start in zip(batch.column(0), batch.column(1).to_pylist()):
            names, lengths, matrix = open_shard(memoryview(data.as_buffer()))
            ends = np.cumsum(lengths, dtype=np.int64)
            tokens = matrix.tokens().astype("<u4")
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(names, pa.int64()), "start": pa.array(start + ends - lengths), "n_tokens": pa.array(lengths.astype(np.int64)),
                "ids_crc32": pa.array([zlib.crc32(tokens[a:b]) for a, b in zip(ends - lengths, ends)], pa.int64())})


def read_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the shard files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; the crc is over the ids as little-endian
    unsigned 32-bit integers.
    """
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(f"{folder}/shards")
    named = files.select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content")
    # file names and starts are some hundred bytes for a shard of megabytes
    return named.join(shard_list(spark, folder), "file").select("content", "start").mapInArrow(
        _read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the shards of ``docs`` to a new folder of the shared one and reads every document back.

    An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = new_path(spark, "token-shards")
    if write_token_shards(docs, folder, tokenizer_file, key, text).isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_shards(spark, folder)
