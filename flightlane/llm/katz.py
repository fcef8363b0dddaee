"""LM scoring: a Katz backoff bigram model, counted over all training texts and evaluated per token."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlane.llm.common import WordHashes, crc_remainder, fold_words
from flightlane.llm.exchange import ANSWERED, SENT, SENT_ARROW, answers_of, block_table, bucket_count, exchange, sent_rows, to_batch
from flightlane.llm.packing import mixed, pack, pack_sorted, unpack, unpack_sorted
from flightlane.session import new_path

#: Counts up to this one are discounted, as Katz has it.
DISCOUNTED = 5
BLOCK_CHARS = 12_000_000
#: No word holds a line break, so this can stand for the end of a text; it is also the context of the first word.
END = b"\n"

_BLOCKS = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("numbers", pa.binary()), ("ids", pa.binary()),
                     ("lengths", pa.binary()), ("names", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_()))])
_BLOCKS_DDL = "block long, keys binary, numbers binary, ids binary, lengths binary, names array<long>, held_out array<boolean>"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """The share of a count that stays with it, for counts 1 to DISCOUNTED (at index 0: 1).

    Good-Turing as Katz scales it. Where the counts of counts give no share between 0 and 1, as in
    small or odd corpora, half a count is taken off instead.
    """
    n = [0, *counts_of_counts]
    k = DISCOUNTED
    cut = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    shares = [1.0]
    for r in range(1, k + 1):
        share = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut != 1 else 0.0
        shares.append(share if 0 < share < 1 else (r - 0.5) / r)
    return np.array(shares)


def kept_share(counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    return np.where(counts <= DISCOUNTED, shares[np.minimum(counts, DISCOUNTED).astype(np.int64)], 1.0)


class Model:
    """What the driver holds of the model: a few totals, whatever the size of the corpus."""

    def __init__(self, tokens: int, types: int, word_counts: list[int], pair_counts: list[int]):
        self.tokens, self.types = tokens, types
        self.word_shares, self.pair_shares = discounts(word_counts), discounts(pair_counts)
        freed = sum(r * n * (1 - self.word_shares[r]) for r, n in enumerate(word_counts[:DISCOUNTED], 1))
        # without rare words nothing is freed for unknown ones: one more token is counted, an unknown one
        self.total = tokens if freed > 0 else tokens + 1
        self.unknown = (freed if freed > 0 else 1.0) / self.total

    def word(self, counts: np.ndarray) -> np.ndarray:
        """The probability of words by their training counts; all unknown words are one type."""
        return np.where(counts > 0, counts * kept_share(counts, self.word_shares) / self.total, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def freed(self, counts: np.ndarray) -> np.ndarray:
        """What discounting takes off pairs of a context."""
        return counts * (1 - kept_share(counts, self.pair_shares))

    def pairs(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray, freed: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """P(word | context), one step back where the pair is unseen and two where the word is, too.

        ``freed`` is what is taken off the pairs of the context, ``seen`` the probability of all words
        seen behind it. Where nothing is freed, one more pair is counted, an unseen one.
        """
        one_more = freed <= 0
        total = np.maximum(context + one_more, 1)
        backoff = np.where(context > 0, np.where(one_more, 1.0, freed) / total / np.maximum(1 - seen, 1e-300), 1.0)
        return np.where(pair > 0, pair * kept_share(pair, self.pair_shares) / total, backoff * self.word(word))


def _blocks(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.RecordBatch]:
    """A row per block: its vocabulary, its tokens as places in it, and its documents."""
    base, number, hashes = TaskContext.get().partitionId() << 16, 0, WordHashes()
    names, held_out, tokens, held = [], [], [], 0

    def flush() -> pa.RecordBatch:
        nonlocal number, names, held_out, tokens, held
        lengths = np.array([len(t) for t in tokens], np.uint32)
        keys, place, n = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        by_count = np.argsort(-n, kind="stable")  # frequent words get small numbers, which pack well
        rank = np.empty(len(keys), np.uint32)
        rank[by_count] = np.arange(len(keys), dtype=np.uint32)
        row = (base + number, pack_sorted(keys), pack(by_count.astype(np.uint32)), pack(rank[place]), pack(lengths), names, held_out)
        number, names, held_out, tokens, held = number + 1, [], [], [], 0
        return to_batch([row], _BLOCKS)

    for batch in batches:
        for name, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            text = text.as_py()
            words = fold_words(text)
            words.append(END)
            names.append(name)
            held_out.append(out)
            tokens.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
            held += len(text or "") + 16
            if held >= chars:
                yield flush()
    if names:
        yield flush()


class Block:
    """A block's tokens, as a task reads them back."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.keys = unpack_sorted(row["keys"])
        self.ids = unpack(row["numbers"])[unpack(row["ids"])].astype(np.int64)
        self.lengths = unpack(row["lengths"]).astype(np.int64)
        self.names, self.held_out = row["names"], np.array(row["held_out"], bool)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.ends = self.starts + self.lengths - 1

    def word_counts(self) -> np.ndarray:
        training = np.repeat(~self.held_out, self.lengths)
        return np.bincount(self.ids[training], minlength=len(self.keys)).astype(np.uint32)

    def with_pairs(self) -> Block:
        """Adds the block's different pairs and where its tokens have them."""
        before = np.roll(self.ids, 1)
        before[self.starts] = self.ids[self.ends]  # the end is the context of the first word
        pairs, self.place = np.unique(before * len(self.keys) + self.ids, return_inverse=True)
        self.first, self.second = np.divmod(pairs, len(self.keys))
        hashed = mixed(self.keys[self.first], self.keys[self.second])
        self.order = np.argsort(hashed, kind="stable")
        self.pair_keys = hashed[self.order]
        return self

    def pair_counts(self) -> np.ndarray:
        training = np.repeat(~self.held_out, self.lengths)
        return np.bincount(self.place[training], minlength=len(self.first)).astype(np.uint32)[self.order]

    def by_pair(self, answers: np.ndarray) -> np.ndarray:
        """Answers in the order of the keys sent, in the order of the pairs."""
        out = np.empty_like(answers)
        out[self.order] = answers
        return out


def _note(counts: np.ndarray) -> bytes:
    rare = np.bincount(np.minimum(counts, DISCOUNTED + 2).astype(np.int64), minlength=DISCOUNTED + 3)
    return json.dumps({"tokens": int(counts.sum()), "types": int(np.count_nonzero(counts)),
                       "rare": rare[1 : DISCOUNTED + 2].tolist()}).encode()


def _word_totals(distinct, place, blocks, numbers):
    counts = np.bincount(place, numbers, len(distinct)).astype(np.uint64)
    return counts[place], _note(counts)


def _pair_totals(distinct, place, blocks, numbers):
    """Twice the training count, and one more for the one block that accounts for the pair."""
    counts = np.bincount(place, numbers, len(distinct)).astype(np.uint64)
    answers = 2 * counts[place]
    _, first = np.unique(place, return_index=True)
    answers[first] += counts > 0
    return answers, _note(counts)


def _context_totals(distinct, place, blocks, numbers):
    totals = np.bincount(place, numbers.real, len(distinct)) + 1j * np.bincount(place, numbers.imag, len(distinct))
    return totals[place], None


def _totals(answers: DataFrame) -> tuple[int, int, list[int]]:
    noted = answers.where("block = -1").select(
        F.from_json(F.col("answer").cast("string"), "tokens long, types long, rare array<long>").alias("x"))
    row = noted.agg(F.sum("x.tokens"), F.sum("x.types"), *(F.sum(F.get("x.rare", F.lit(i))) for i in range(DISCOUNTED + 1))).first()
    tokens, types, *rare = [x or 0 for x in row]
    return tokens, types, rare


def _answers(right: pa.Table) -> dict[str, np.ndarray]:
    by_kind: dict[str, list] = {}
    for r in right.to_pylist():
        by_kind.setdefault(r["about"], []).append((r["bucket"], r["answer"]))
    return {kind: answers_of(rows) for kind, rows in by_kind.items()}


def _send(buckets: int, rows_of):
    """Sends what ``rows_of`` gives of a block: keys and their training counts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                yield to_batch(list(sent_rows(block.block, *rows_of(block), buckets)), SENT_ARROW)

    return send


def _words_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    return block.keys, block.word_counts()


def _pairs_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    block.with_pairs()
    return block.pair_keys, block.pair_counts()


def _send_contexts(model: Model, buckets: int):
    """What the pairs that a block accounts for add to their contexts."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        block, told = Block(left.to_pylist()[0]).with_pairs(), _answers(right)
        pairs = block.by_pair(told["pairs"])
        mine = pairs % 2 == 1
        counts, first, second = pairs[mine] // 2, block.first[mine], block.second[mine]
        freed = np.bincount(first, model.freed(counts), len(block.keys))
        seen = np.bincount(first, model.word(told["words"][second]), len(block.keys))
        return pa.Table.from_batches([to_batch(list(sent_rows(block.block, block.keys, freed + 1j * seen, buckets)), SENT_ARROW)])

    return send


def _score(model: Model):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        block, told = Block(left.to_pylist()[0]).with_pairs(), _answers(right)
        words, contexts = told["words"], told["contexts"]
        log = np.log10(model.pairs(block.by_pair(told["pairs"]) // 2, words[block.first], words[block.second],
                                   contexts.real[block.first], contexts.imag[block.first]))
        known, base = (words > 0).astype(np.int64)[block.ids], model.base(words.astype(np.float64))[block.ids]
        return pa.table({
            "doc_id": pa.array(block.names, pa.int64()), "held_out": pa.array(block.held_out), "n_tokens": pa.array(block.lengths),
            "n_known": pa.array(np.add.reduceat(known, block.starts)), "train_tokens": pa.array([model.tokens] * len(block.names), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, block.starts)), "score": pa.array(np.add.reduceat(log[block.place], block.starts))})

    return score


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from rows whose crc32 of the key modulo ``folds`` is not 0 and scores all rows;
    ``score`` is the log10 probability of the whole text and its end. Null and empty texts are the end
    alone. A null key counts as training; rows that repeat a key or a text count as often as they are
    there. The key is an integer; other columns are ignored; an empty table gives an empty result.

    Blocks of documents hold their tokens packed. Word counts, pair counts and context totals are
    added up by key range (see ``exchange``) and written to the shared folder as tables by bucket
    and block, which is how the model is stored; each block is answered for its own keys, so every
    task evaluates its tokens with counts over all training texts. Probabilities of every context
    sum to one over the known words and one unknown type. Words and pairs are told apart by 64-bit
    hashes.
    """
    spark = docs.sparkSession
    buckets = bucket_count(spark)
    held_out = F.coalesce(crc_remainder(key, folds) == 0, F.lit(False))
    texts = block_table(docs.select(F.col(key).cast("long"), held_out, F.col(text)).toDF("doc_id", "held_out", "text").mapInArrow(
        lambda batches: _blocks(batches, block_chars), _BLOCKS_DDL), "token-blocks")

    def told(about: str, sent: DataFrame, answer) -> DataFrame:
        rows = exchange(sent, answer)
        table = new_path(spark, f"katz-{about}")
        rows.write.parquet(table)
        return spark.read.schema(ANSWERED).parquet(table).withColumn("about", F.lit(about))

    def together(*answers: DataFrame):
        rows = answers[0]
        for more in answers[1:]:
            rows = rows.unionByName(more)
        return texts.groupBy("block").cogroup(rows.where("block >= 0").groupBy("block"))

    words = told("words", texts.mapInArrow(_send(buckets, _words_of), SENT), _word_totals)
    pairs = told("pairs", texts.mapInArrow(_send(buckets, _pairs_of), SENT), _pair_totals)
    tokens, types, word_counts = _totals(words)
    model = Model(tokens, types, word_counts, _totals(pairs)[2])
    contexts = told("contexts", together(words, pairs).applyInArrow(_send_contexts(model, buckets), SENT), _context_totals)
    return together(words, pairs, contexts).applyInArrow(_score(model), _SCORES)
