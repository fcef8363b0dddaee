"""Token counts: unigram segmentation of the different words of many texts, shared along a trie."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlane.llm.common import kept
from flightlane.llm.sentencepiece_fst import Transducer, model_bytes

#: Words whose counts a worker remembers from one batch to the next.
WORDS_KEPT = 1_000_000
#: Texts whose words go into one trie: so many characters, and the rest of the last text.
TRIE_CHARS = 8_000_000


class TrieCounter:
    """Token counts of words under the best unigram segmentation.

    Different words in sorted order are a trie in depth-first order. The path to the current node is
    kept with the forward score and token count of every node on it, so what words share at their
    starts is scored once. The count at the end of a word is its terminal count.

    Models of merges hold ranks instead of probabilities; their pieces get the probabilities of
    Zipf's law, proportional to 1 / rank. An unknown character counts as its bytes where the model
    has byte fallback, else as one token.
    """

    def __init__(self, data: bytes):
        self.transducer = t = Transducer(data)
        self.terminal: dict[str, int] = {}
        scores = {p: -math.log(1.0 + max(0.0, -t.scores[p])) if t.model.bpe else t.scores[p] for p in t.ids}
        self.unknown = min(scores.values(), default=0.0) - 10.0
        self.scores = scores
        self.ends: dict = {}  # pieces from their last character to their first
        for piece, score in scores.items():
            node = self.ends
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = score

    def chunks(self, text: str | None) -> list[str]:
        """The parts of a text that no piece reaches over."""
        normal = self.transducer.normalise(text or "")
        return self.transducer.chunk.findall(normal) if self.transducer.by_word else [normal] if normal else []

    def learn(self, words: Iterable[str]) -> None:
        """Inserts words in the trie and stores their terminal counts."""
        new = [w for w in words if w not in self.terminal]
        if len(self.terminal) + len(new) > WORDS_KEPT:
            self.terminal.clear()
            new = list(words)
        score, count, before = [0.0], [0], ""
        for word in sorted(new):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del score[shared + 1 :], count[shared + 1 :]
            for end in range(shared, len(word)):
                node = self.ends.get(word[end])
                single = node.get("") if node else None
                if single is None:
                    single, size = self.unknown, len(word[end].encode()) if self.transducer.model.byte_fallback else 1
                else:
                    size = 1
                best, n, start = score[end] + single, count[end] + size, end
                while node and start:
                    start -= 1
                    node = node.get(word[start])
                    if node and "" in node and score[start] + node[""] >= best:  # of equal scores the longer last piece
                        best, n = score[start] + node[""], count[start] + 1
                score.append(best)
                count.append(n)
            self.terminal[word] = count[len(word)]
            before = word

    def counts(self, texts: list[str | None]) -> Iterator[tuple[int, int]]:
        """Words and tokens of each text."""
        at = 0
        while at < len(texts):
            held, parts = 0, []
            while at < len(texts) and held < TRIE_CHARS:
                parts.append(self.chunks(texts[at]))
                held += len(texts[at] or "")
                at += 1
            self.learn(set().union(*parts))
            for words in parts:
                yield len(words), sum(map(self.terminal.__getitem__, words))


def token_counts(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, n_parts, n_tokens; null and empty texts count nothing.

    A part is a word with the spaces before it, or a line break. Every text is counted whole, so null
    keys, repeated rows and ties are rows like any other; other columns are ignored; an empty table
    gives an empty result. Nothing is shuffled: each task has a trie of the words it meets.
    """
    data = model_bytes(model_file)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept(("counter", hash(data)), lambda: TrieCounter(data))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = np.array(list(counter.counts(texts)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t or "") for t in texts], pa.int64()), pa.array(found[:, 0]), pa.array(found[:, 1])],
                                             names=["doc_id", "n_chars", "n_parts", "n_tokens"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        count, "doc_id long, n_chars long, n_parts long, n_tokens long")
