"""Whitening of embeddings by shifted CholeskyQR over distributed Gram matrices.

The fit list A (distinct vectors, centred) is never held anywhere: a pass over it gives the Gram
matrix of A R^-1 for the triangle R found so far, each task solving for its own rows. The Cholesky factor of that
matrix, shifted where it is close to singular, multiplies R. What is left of the Gram matrix G
(the identity, but for directions without variance) goes into the last step: A'A = R'GR, so the singular
values and right vectors of sqrt(G) R are those of A.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.llm.ranks import exact
from flightlane.session import stored

#: Entries become whole numbers of 1 / SCALE.
SCALE = 256
#: Tasks' matrices are added up in so many groups before the driver adds up the groups.
GROUPS = 64
#: Gram matrices are taken at most so often.
PASSES = 6
EPSILON = np.finfo(np.float64).eps
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vector: Column) -> Column:
    """Neither null nor with an entry that is null or not finite."""
    def odd(entry: Column) -> Column:
        value = entry.cast("double")
        return entry.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))

    return vector.isNotNull() & ~F.exists(vector, odd)


def whole_entries(vector: Column, scale: int = SCALE) -> Column:
    """Each entry as double times ``scale``, rounded down to a long; beyond its range the nearest long."""
    return F.transform(vector, lambda entry: F.floor(entry.cast("double") * scale).cast("long"))


@dataclass
class Whitening:
    """What a fit finds: ``n`` vectors, their exact ``sums`` by dimension, unit ``components`` (one a row) by
    falling variance, ``variances``, the ``trace`` of the covariance and the error of the whitened covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


def fit(rows: DataFrame, vector: str = "embedding", components: int = 4, scale: int = SCALE) -> Whitening:
    """Whitening of the distinct usable vectors of ``rows``.

    Only vectors of the most frequent length among the distinct ones count (of equally frequent ones the
    longest). Directions without variance are no components, so there may be fewer than asked for,
    and none for an empty table or one vector. Repeated vectors are reduced in each task before they are dealt out,
    and a pass moves one small matrix for each task.
    """
    found = rows.where(usable(exact(vector))).select(whole_entries(exact(vector), scale).alias("x"))
    listed = stored(found.distinct(), "fit-list")
    lengths = listed.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if most is None or most["d"] == 0:
        return Whitening(0 if most is None else most["n"], [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    n, d = most["n"], most["d"]
    listed = listed.where(F.size("x") == d)
    sums = _sums(listed, d)
    r, gram = _factors(listed, n, sums)
    # the symmetric root of what is left: the identity, less the directions without variance
    left, axes = np.linalg.eigh(gram)
    _, singular, right = np.linalg.svd((axes * np.sqrt(np.maximum(left, 0))) @ axes.T @ r)
    variances = singular ** 2 / n
    real = variances > variances[0] * d * d * EPSILON if variances[0] > 0 else variances > 0
    variances, right = variances[real], right[real]
    trace = float(variances.sum())
    variances, right = variances[:components], right[:components]
    # either sign is right; the largest entry is positive here, so that runs agree
    right = right * np.where(np.take_along_axis(right, np.abs(right).argmax(axis=1)[:, None], 1) < 0, -1.0, 1.0) if len(right) else right
    error = 0.0
    if len(right):
        weights = right.T / np.sqrt(variances)
        covariance = _gram(listed, lambda x: _centred(x, n, sums) @ weights, d, len(right)) / n
        error = float(np.abs(covariance - np.eye(len(right))).max())
    return Whitening(n, sums, right, variances, trace, error)


def whiten(rows: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The key, and the columns of RESULT, for each usable row of the model's length and each component.

    ``deviation`` is the exact sum of (n * x - S) ** 2, null where it is beyond a long. Null, non-finite and
    ragged vectors give no row; repeated rows give theirs each; other columns are ignored.
    """
    n, sums, d = model.n, model.sums, len(model.sums)
    weights = model.components.T / np.sqrt(model.variances) if len(model.variances) else np.zeros((d, 0))
    count, explained, error = len(model.variances), model.variances / (model.trace or 1.0), model.identity_error
    kept = rows.where(usable(exact(vector)) & (F.size(exact(vector)) == d)) if d else rows.where(F.lit(False))
    taken = kept.select(exact(key).alias("key"), whole_entries(exact(vector), scale).alias("x"))
    kind = rows.schema[key].dataType

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            values, size = _centred(x, n, sums) @ weights, len(x) * count
            place = pa.array(np.repeat(np.arange(len(x)), count))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(place), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(size, n, np.int64)), pa.array(_deviations(x, n, sums), pa.int64()).take(place),
                pa.array(values.reshape(-1)), pa.array(np.tile(explained, len(x))), pa.array(np.full(size, error)),
            ], names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    result = taken.mapInArrow(of_batches, f"key {kind.simpleString()}, {RESULT}")
    return result.withColumnRenamed("key", key)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _fits(x: np.ndarray, n: int, sums: list[int], power: int = 1) -> bool:
    """Whether n * x - S, to a power and summed over the dimensions, stays within a long."""
    most = max((abs(int(v)) for v in (x.min(), x.max())), default=0) if x.size else 0
    return (n * most + max(map(abs, sums), default=0)) ** power * len(sums) < 1 << 62


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n; exact up to the division where the whole numbers fit."""
    if _fits(x, n, sums):
        return (x * n - np.array(sums, np.int64)) / n
    return x.astype(np.float64) - np.array([s / n for s in sums])


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None] | np.ndarray:
    if _fits(x, n, sums, 2):
        return ((x * n - np.array(sums, np.int64)) ** 2).sum(axis=1)
    exactly = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [v if v < 1 << 63 else None for v in exactly]


def _sums(listed: DataFrame, d: int) -> list[int]:
    """Exact sums by dimension."""
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            x = _matrix(batch.column(0), d)
            summed = x.sum(axis=0) if _fits(x, len(x), [0]) else [sum(map(int, c)) for c in x.T]
            total = [a + int(b) for a, b in zip(total, summed)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(map(str, total))], names=["i", "s"])

    by_task = listed.mapInArrow(of_task, "i int, s string")
    rows = by_task.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return [int(r["s"]) for r in sorted(rows)]


def _gram(listed: DataFrame, of_rows: Callable[[np.ndarray], np.ndarray], d: int, width: int) -> np.ndarray:
    """Y'Y of what ``of_rows`` makes of the rows: a matrix for each task, GROUPS of them for the driver."""
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = of_rows(_matrix(batch.column(0), d))
            total += y.T @ y
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([task % GROUPS], pa.int32()), pa.array([task], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         names=["slot", "task", "sum"])

    def of_slot(group: pa.Table) -> pa.Table:
        parts = sorted(zip(group["task"].to_pylist(), group["sum"].to_pylist()))
        total = sum(np.frombuffer(data) for _, data in parts)
        return pa.table({"slot": group["slot"][:1], "sum": pa.array([total.tobytes()], pa.binary())})

    by_task = listed.mapInArrow(of_task, "slot int, task int, sum binary")
    rows = by_task.groupBy("slot").applyInArrow(of_slot, "slot int, sum binary").collect()
    return sum((np.frombuffer(r["sum"]) for r in sorted(rows)), np.zeros(width * width)).reshape(width, width)


def solved(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q R = Y for an upper triangle R, column by column."""
    q = np.empty_like(y)
    for j in range(r.shape[0]):
        q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _factors(listed: DataFrame, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """R and the Gram matrix of A R^-1."""
    d = len(sums)
    r = np.eye(d)
    for made in range(PASSES):
        def of_rows(x: np.ndarray, r: np.ndarray = r, first: bool = made == 0) -> np.ndarray:
            centred = _centred(x, n, sums)
            return centred if first else solved(centred, r)

        gram = _gram(listed, of_rows, d, d)
        rest = np.abs(np.linalg.eigvalsh(gram) - 1)
        # after two factors a direction is orthonormal, or has no variance that doubles can tell from rounding
        if made and rest.max() < d * d * 8 * EPSILON or made > 1 and np.minimum(rest, np.abs(rest - 1)).max() < 1e-8 or not gram.any():
            break
        norm = np.linalg.norm(gram, 2)
        shift = 11 * (n * d + d * (d + 1)) * EPSILON * norm if made == 0 else 0.0
        r = _cholesky(gram, shift, 11 * d * (d + 1) * EPSILON * norm) @ r
    return r, gram


def _cholesky(gram: np.ndarray, shift: float, least: float) -> np.ndarray:
    """The upper factor of the matrix, shifted by more where it is not positive in doubles."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(2 * shift, least)
