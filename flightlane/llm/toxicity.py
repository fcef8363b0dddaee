"""Toxicity by compression distance: zstandard dictionaries of toxic and ordinary text, compared window by window."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlane.llm.common import crc_remainder, fold_words, forget, free_name, give_back, small
from flightlane.session import stored

WINDOW_WORDS = 24
#: Labelled documents that are learnt from, on average, and of their windows those that dictionaries are made of.
TOXIC_DOCS, ORDINARY_DOCS = 3_000, 9_000
TOXIC_WINDOWS, ORDINARY_WINDOWS = 100_000, 150_000
#: Bytes of what both dictionaries of a pair share, and of what each has for itself in the rounds of training.
SHARED_BYTES, OWN_BYTES = 98_304, (16_384, 8_192, 4_096, 4_096)
#: Pairs of dictionaries, each from windows dealt out anew; what one misses another may have.
PAIRS = 3
#: The share of ordinary windows whose gain lies above the threshold of windows.
ORDINARY_ABOVE = 0.01
LEVEL = 6
FEATURES = 4


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=128, dict_size=len(content), write_content_size=0, write_checksum=0, write_dict_id=0)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


@dataclass(frozen=True)
class Pair:
    """A toxic and an ordinary dictionary, and the gain that makes a window stand out."""

    toxic: bytes
    ordinary: bytes
    threshold: float = 0.0

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return _compressor(self.toxic), _compressor(self.ordinary)


@dataclass(frozen=True)
class Detector:
    """Pairs of dictionaries, and the weights that make a score of a document's gains."""

    pairs: tuple[Pair, ...]
    weights: tuple[float, ...] = ()

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The calibrated probability of the label, from rows of features."""
        x = rows @ np.array(self.weights[1:]) + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def windows(text: str | None) -> list[bytes]:
    """Runs of WINDOW_WORDS words of the whole text, A-Z lower-cased."""
    words = fold_words(text)
    return [b" " + b" ".join(words[i : i + WINDOW_WORDS]) + b" " for i in range(0, len(words), WINDOW_WORDS)]


def gains(compressors, some: list[bytes]) -> np.ndarray:
    """How many bytes shorter each window is with the toxic dictionary than with the ordinary one."""
    toxic, ordinary = (c.compress for c in compressors)
    return np.array([len(ordinary(w)) - len(toxic(w)) for w in some], np.float64)


def features(g: np.ndarray, threshold: float) -> list[float]:
    """What the gains of a document's windows say of it; nothing for a text without words."""
    if not len(g):
        return [0.0] * FEATURES
    above = g > threshold
    n = len(g) ** 0.5
    return [g.sum() / n, above.sum() / n, above.mean(), min(g.max(), 20.0) - threshold]


def _content(samples: list[bytes], size: int) -> bytes:
    """What a trained dictionary consists of, without its header: the segments that most samples share."""
    if sum(map(len, samples)) < 4 * size:
        return b"".join(samples)[-size:]
    try:
        data = zstandard.train_dictionary(size, samples, k=16, d=6).as_bytes()
    except zstandard.ZstdError:  # too little that is repeated
        return b"".join(samples)[-size:]
    start = data.find(b"\x01\x00\x00\x00\x04\x00\x00\x00\x08\x00\x00\x00")  # the offsets behind the header
    return data[start + 12 :] if start >= 0 else data


def _dealt(some: list[bytes], dice: random.Random) -> list[bytes]:
    """The words of windows in random order, so that no dictionary holds copied passages."""
    words = b" ".join(some).split()
    dice.shuffle(words)
    return [b" " + b" ".join(words[i : i + 8]) + b" " for i in range(0, len(words), 8)]


def train(toxic: list[bytes], ordinary: list[bytes], seed: int = 7) -> Pair:
    """A pair of dictionaries from windows of toxic and ordinary documents.

    Most of a toxic document is ordinary text. So both dictionaries share what is frequent in
    ordinary windows, and the toxic one is trained in rounds: with what one half of the toxic windows
    gives, the windows of the other half are told that gain more than nearly all ordinary windows do,
    and the next, smaller dictionary is trained on those alone.
    """
    dice = random.Random(seed)
    ordinary = sorted(ordinary)
    dice.shuffle(ordinary)
    third = len(ordinary) // 3
    shared, control, check = _dealt(ordinary[:third], dice), _dealt(ordinary[third : 2 * third], dice), ordinary[2 * third :]
    base = _content(shared, SHARED_BYTES)
    halves = sorted(toxic)
    dice.shuffle(halves)
    halves = [halves[::2], halves[1::2]]
    chosen = [_dealt(h, dice) for h in halves]

    def pair(samples: list[bytes], size: int) -> Pair:
        return Pair(_content(samples, size) + base, _content(control, size) + base)

    def threshold(trained: Pair) -> float:
        return float(np.quantile(gains(trained.compressors(), check), 1 - ORDINARY_ABOVE)) if check else 0.0

    for size in OWN_BYTES[:-1]:
        following = []
        for own, other in ((1, 0), (0, 1)):
            trained = pair(chosen[own], size)
            g, least = gains(trained.compressors(), halves[other]), threshold(trained)
            following.append(_dealt([w for w, x in zip(halves[other], g) if x > least], dice))
        chosen = [f or c for f, c in zip(following, chosen)]
    last = pair(chosen[0] + chosen[1], OWN_BYTES[-1])
    return Pair(last.toxic, last.ordinary, threshold(last))


def calibrate(pairs: tuple[Pair, ...], rows: np.ndarray, labels: np.ndarray, rounds: int = 50) -> Detector:
    """Logistic regression of the label on the features, by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(rows)), rows])
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (labels - p) - 1e-2 * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return Detector(pairs, tuple(weights.tolist()))


def _features_of(pairs: tuple[Pair, ...]):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        compressors = [p.compressors() for p in pairs]
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                some = windows(text.as_py())
                rows.append([x for p, c in zip(pairs, compressors) for x in features(gains(c, some), p.threshold)])
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(rows, pa.list_(pa.float64()))], names=[*names, "features"])
        give_back()

    return of


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = windows(text.as_py())
            yield pa.RecordBatch.from_pydict({"label": pa.array([y] * len(found), pa.int32()), "w": pa.array(found, pa.binary())})


def _train_pair(group: pa.Table) -> pa.Table:
    w, toxic = group["w"].to_pylist(), np.array(group["label"]) == 1
    seed = group["seed"][0].as_py()
    pair = train([x for x, y in zip(w, toxic) if y], [x for x, y in zip(w, toxic) if not y], seed)
    give_back()
    return pa.table({"seed": pa.array([seed], pa.int32()), "toxic": [pair.toxic], "ordinary": [pair.ordinary], "threshold": [pair.threshold]})


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5,
        toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS, toxic_windows: int = TOXIC_WINDOWS,
        ordinary_windows: int = ORDINARY_WINDOWS) -> Detector:
    """A detector from labelled rows whose crc32 of the key modulo ``folds`` is not 0.

    The sample is bounded by ``toxic_docs`` and ``ordinary_docs``, about as many rows being drawn by a hash
    of their key. A third of them is kept for the calibration; of the windows of the others about
    ``toxic_windows`` and ``ordinary_windows`` are drawn, anew for each pair, and a task per pair trains its dictionaries, so what a task holds has a fixed size. The driver gets
    the dictionaries and the features of the calibration rows. Rows without a label or key are not
    learnt from, other columns are ignored; without any rows every score is one half.
    """
    known = labels.where(F.col(label).isin(0, 1) & (crc_remainder(key, folds) != 0)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64("key", F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("label") == 1, toxic_docs / max(1, counts.get(1, 0))).otherwise(ordinary_docs / max(1, counts.get(0, 0)))
    picked = known.where(draw < share).groupBy("key").agg(F.max("label").alias("label"))
    # a sample of fixed size on average, so broadcasting its keys is bounded
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    sample = stored(texts.join(F.broadcast(picked), F.col("doc") == F.col("key")).select("key", "label", "text"), "toxicity-sample")
    last = F.pmod(F.xxhash64("key", F.lit("calibration")), F.lit(3)) == 0
    cuts = stored(sample.where(~last).select("label", "text").mapInArrow(_cut, "label int, w binary"), "toxicity-windows")
    sizes = {r["label"]: r["count"] for r in cuts.groupBy("label").count().collect()}
    part = F.when(F.col("label") == 1, toxic_windows / max(1, sizes.get(1, 0))).otherwise(ordinary_windows / max(1, sizes.get(0, 0)))
    seeds = F.explode(F.array(*map(F.lit, range(1, PAIRS + 1)))).alias("seed")
    dealt = cuts.select("label", "w", seeds).where(F.pmod(F.xxhash64("w", "seed"), F.lit(1 << 20)) / float(1 << 20) < part)
    found = dealt.groupBy("seed").applyInArrow(_train_pair, "seed int, toxic binary, ordinary binary, threshold double").collect()
    pairs = tuple(Pair(bytes(r["toxic"]), bytes(r["ordinary"]), r["threshold"]) for r in sorted(found))
    rows = sample.where(last).select("label", "text").mapInArrow(_features_of(pairs), "label int, features array<double>").collect()
    return calibrate(pairs, np.array([r["features"] for r in rows], np.float64).reshape(len(rows), FEATURES * len(pairs)),
                     np.array([r["label"] for r in rows], np.float64))


def toxicity(docs: DataFrame, detector: Detector, key: str = "doc_id", text: str = "text", folds: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, text_hash, score, predicted. Nothing is shuffled.

    Every window of the whole text counts; null and empty texts get the score of a text without
    gains. The score depends on the text alone, so repeated rows get equal scores; a null key is not
    held out. Other columns are ignored; an empty table gives an empty result.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _features_of(detector.pairs)(batches):
            rows = np.array(batch.column(3).to_pylist(), np.float64).reshape(batch.num_rows, FEATURES * len(detector.pairs))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(detector.score(rows))], names=["doc_id", "held_out", "text_hash", "score"])

    held_out = F.coalesce(crc_remainder(key, folds) == 0, F.lit(False))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out.alias("held_out"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, text_hash long, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with all their columns.

    Rows go by key and text, so a null or repeated key takes no other row along.
    """
    name, mark = free_name(docs, "gone_key"), free_name(docs, "gone_text")
    gone = toxicity(docs, fit(docs, labels, key, text), key, text).where("predicted = 1").select("doc_id", "text_hash").distinct().toDF(name, mark)
    gone = stored(gone, "toxic-rows")
    return docs.join(small(gone), docs[key].cast("long").eqNullSafe(gone[name]) & (F.xxhash64(docs[text]) == gone[mark]), "left_anti")
