"""Mixing to target weights: soft membership in domains, and document rates fitted to target totals."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.llm.common import ascii_lower, free_name, small, whole, words
from flightlane.session import stored

#: Labelled rows that the classifier is fitted on, on average.
SAMPLE_ROWS = 20_000
#: Words are told apart by this many buckets, so the classifier's table has a fixed size.
BUCKETS = 4096
#: Evidence counts as of this many words at most, so that memberships of long texts stay soft.
EVIDENCE_WORDS = 20
#: Passes over the rows at most, and the share of its target by which a total may miss it.
PASSES, TOLERANCE = 200, 1e-5
#: Passes after which what projected gradient has not brought to its targets is left to the dual.
GRADIENT_PASSES = 30
#: What is left of a miss that no rates could close is weighed against the size of the rates by this.
RIDGE = 1e-10


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def fit_classifier(docs: DataFrame, domains: list[str], label: str, key: str, text: str, sample_rows: int) -> DataFrame:
    """bucket, score: for every word bucket the log10 probability under each domain, in the order of ``domains``.

    Multinomial naive Bayes with add-one smoothing, on labelled rows picked by a hash of their key.
    """
    labelled = docs.where(F.col(label).isin(domains)).select(
        F.col(label).alias("domain"), F.crc32(F.col(key).cast("string").cast("binary")).alias("pick"), F.col(text).alias("text"))
    share = min(1.0, sample_rows / max(1, labelled.count()))
    picked = labelled.where(F.col("pick") < int(share * 2**32))
    counts = picked.select("domain", F.explode(words(ascii_lower(whole("text")))).alias("word")).groupBy(
        "domain", _bucket(F.col("word")).alias("bucket")).agg(F.count("*").alias("n"))
    by_domain = counts.groupBy("bucket").pivot("domain", domains).agg(F.first("n"))
    wide = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(F.broadcast(by_domain), "bucket", "left")
    wide = stored(wide.na.fill(0), "domain-counts")
    totals = wide.agg(*(F.sum(F.col(f"`{d}`")) for d in domains)).first()
    return wide.select("bucket", F.array(*(F.log10((F.col(f"`{d}`") + 1.0) / (float(n) + BUCKETS)) for d, n in zip(domains, totals))).alias("score"))


def memberships(docs: DataFrame, domains: list[str], label: str = "lang", key: str = "doc_id", text: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, domain, n_tokens, p (the posteriors, in the order of ``domains``).

    Every domain is equally likely beforehand, so a text without words belongs to all alike.
    """
    # a table of BUCKETS rows, so broadcasting it has a fixed size
    model = F.broadcast(fit_classifier(docs, domains, label, key, text, sample_rows))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.col(label).alias("domain"),
                       words(ascii_lower(whole(text))).alias("w"))
    spread = rows.select("row", "doc_id", "domain", F.explode_outer("w").alias("word"))
    scored = spread.withColumn("bucket", _bucket(F.col("word"))).join(model, "bucket", "left")
    sums = scored.groupBy("row", "doc_id", "domain").agg(
        F.count("word").alias("n_tokens"),
        *(F.sum(F.when(F.col("word").isNotNull(), F.get("score", F.lit(i)))).alias(f"s{i}") for i in range(len(domains))))
    evidence = [F.coalesce(F.col(f"s{i}"), F.lit(0.0)) * F.least(F.lit(1.0), EVIDENCE_WORDS / F.greatest(F.col("n_tokens"), F.lit(1)))
                for i in range(len(domains))]
    likely = sums.select("doc_id", "domain", "n_tokens", F.array(*evidence).alias("e"))
    weights = likely.withColumn("e", F.transform("e", lambda x: F.pow(F.lit(10.0), x - F.array_max("e"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return weights.withColumn("total", total).select("doc_id", "domain", "n_tokens", F.transform("e", lambda x: x / F.col("total")).alias("p"))


def _dot(x: Column | str, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda a, v: a + v)


def _numbers(some) -> Column:
    return F.array(*(F.lit(float(x)) for x in some))


@dataclass(frozen=True)
class Step:
    """A move along the memberships, for all rows but those that are held: at the least rate, where
    the slope would take them below it."""

    move: tuple[float, ...]
    slope: tuple[float, ...]


def _held(rate: Column, slope: Column, least: float) -> Column:
    return (rate <= least) & (_dot("p", slope) >= 0)


def _rate(steps: list[Step], least: float) -> Column:
    """The rate of a document after the given steps: from one, each step moves it along its
    memberships, never below ``least``. It follows from the row alone, so no state is kept."""
    rate = F.lit(max(1.0, least))
    if not steps:
        return rate
    taken = F.array(*(F.struct(_numbers(s.move).alias("move"), _numbers(s.slope).alias("slope")) for s in steps))

    def moved(r, step):
        return F.when(_held(r, step["slope"], least), r).otherwise(F.greatest(F.lit(least), r + _dot("p", step["move"])))

    return F.aggregate(taken, rate, moved)


def _totals(rows: DataFrame, rate: Column, k: int) -> list[float]:
    sums = [F.sum(F.col("n_tokens") * F.col("rate") * F.get("p", F.lit(i))) for i in range(k)]
    return [float(x or 0.0) for x in rows.withColumn("rate", rate).agg(*sums).first()]


def _moved(move: np.ndarray, least: float) -> tuple[Column, Column]:
    """What a document's rate would be without ``least`` after a move along its memberships, and its
    rate. Documents without tokens stay where they are."""
    along = F.aggregate(F.zip_with("p", F.array(*(F.lit(float(x)) for x in move)), lambda p, m: p * m), F.lit(0.0), lambda a, x: a + x)
    free = F.lit(max(1.0, least)) + F.when(F.col("n_tokens") > 0, along).otherwise(0.0)
    return free, F.greatest(F.lit(least), free)


def _dual(rows: DataFrame, move: np.ndarray, least: float, budget: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The value of the dual without its targets, its gradient (the totals) and its second derivative, as shares of the budget."""
    k = len(move)
    free, rate = _moved(move, least)
    p = [F.get("p", F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = rows.select("n_tokens", "p", free.alias("free"), rate.alias("rate")).agg(
        F.sum(F.col("n_tokens") * F.col("rate") * (F.col("free") - F.col("rate") / 2)),
        *(F.sum(F.col("n_tokens") * F.col("rate") * x) for x in p),
        *(F.sum(F.when(F.col("free") >= least, F.col("n_tokens") * p[i] * p[j]).otherwise(0.0)) for i, j in pairs)).first()
    value, *rest = (float(x or 0.0) / budget for x in sums)
    curve = np.zeros((k, k))
    for (i, j), x in zip(pairs, rest[k:]):
        curve[i, j] = curve[j, i] = x
    return value, np.array(rest[:k]), curve


def _curve(rows: DataFrame, rate: Column, slope: np.ndarray, least: float) -> np.ndarray:
    """How the totals change with a move of the rows that are not held: the sums of n_tokens * p_i * p_j."""
    k = len(slope)
    p, pairs = [F.get("p", F.lit(i)) for i in range(k)], [(i, j) for i in range(k) for j in range(i, k)]
    free = rows.withColumn("rate", rate).where(~_held(F.col("rate"), _numbers(slope), least))
    sums = free.agg(*(F.sum(F.col("n_tokens") * p[i] * p[j]) for i, j in pairs)).first()
    curve = np.zeros((k, k))
    for (i, j), x in zip(pairs, sums):
        curve[i, j] = curve[j, i] = float(x or 0.0)
    return curve


def meets(totals: list[float], targets: list[float], tolerance: float = TOLERANCE) -> bool:
    """Whether all totals meet their targets; for a target of zero a miss is a share of the budget."""
    budget = sum(targets)
    return all(abs(s - t) <= tolerance * (t if t > 2e-9 * budget else budget) for s, t in zip(totals, targets))


def fit_rates(rows: DataFrame, weights: list[float], budget: float | None = None, least: float = 0.0,
              iterations: int | None = None, tolerance: float = TOLERANCE) -> tuple[Column, list[float], list[float]]:
    """The rate column, the expected token totals under it, and the target totals.

    Rates of at least ``least`` (which is not negative) are fitted so that the totals S_k, the sums of r *
    n_tokens * p_k, meet the targets t_k: projected gradient for sum_k (S_k - t_k)^2 / t_k from one per
    token, each step scaled by the curvature among the rows that are not held at the least rate, and
    shortened until the sum falls. A pass over the rows gives k totals or k * k sums, the driver nothing
    else. Where the bounds leave hardly any rates, steps get short; what has not arrived after
    GRADIENT_PASSES is fitted by the dual instead (``_solved``): of all rates that meet the targets
    those closest to one per token. Where no rates meet the targets, the sum is least (a zero target
    counts there as the budget), and a warning names totals and targets. ``iterations`` asks for the rates
    after so many steps of one length instead.

    ``budget`` is the total of the targets; by default the least with which no domain has to shrink. A
    target of zero counts as 1e-9 of the budget.
    """
    k = len(weights)
    now = _totals(rows, _rate([], least), k)
    if sum(now) == 0 or sum(weights) <= 0:
        return _rate([], least), now, now
    shares = [w / sum(weights) for w in weights]
    budget = budget or max(s / w for s, w in zip(now, shares) if w > 0)
    targets = [max(share * budget, 1e-9 * budget) for share in shares]
    if iterations is None:
        rate, now, done = _descended(rows, np.array(targets) / budget, least, budget, tolerance)
        if not done:
            move, now = _solved(rows, np.array(targets) / budget, least, budget, tolerance)
            rate = _moved(move, least)[1]
        if not meets(now, targets, tolerance):
            warnings.warn(f"no rates of {least} or more found that meet the targets: totals {now}, targets {targets}", stacklevel=2)
        return rate, now, targets
    # GW has no eigenvalue above its largest column sum
    size = 1.0 / max(s / t for s, t in zip(now, targets))
    steps: list[Step] = []
    before = targets  # ends at the targets, or where a step no longer changes anything
    while len(steps) < iterations and all(max(abs(s - t) for s, t in zip(now, x)) > tolerance * budget for x in (targets, before)):
        slope = [(s - t) / t for s, t in zip(now, targets)]
        steps.append(Step(tuple(-size * x for x in slope), tuple(slope)))
        before, now = now, _totals(rows, _rate(steps, least), k)
    return _rate(steps, least), now, targets


def _descended(rows: DataFrame, targets: np.ndarray, least: float, budget: float, tolerance: float) -> tuple[Column, list[float], bool]:
    """The rate after projected gradient steps, the totals, and whether it is done: the targets (shares
    of the budget) are met, or no step makes the misses less."""
    weighed = np.where(targets > 2e-9, targets, 1.0)  # a target of zero must not outweigh the others
    root, k = 1 / np.sqrt(weighed), len(targets)
    rows = rows.where("n_tokens > 0")  # documents without tokens stay where they are
    steps: list[Step] = []

    def totals(taken: list[Step]) -> np.ndarray:
        return np.array(_totals(rows, _rate(taken, least), k)) / budget

    def rate() -> Column:
        return F.when(F.col("n_tokens") > 0, _rate(steps, least)).otherwise(F.lit(max(1.0, least)))

    now, passes, done = totals(steps), 1, False
    while not done and passes < GRADIENT_PASSES:
        miss = root * (now - targets)
        if (np.abs(now - targets) <= tolerance / 10 * weighed).all():
            done = True
            break
        slope = root * miss
        curve = root[:, None] * (_curve(rows, _rate(steps, least), slope, least) / budget) * root
        passes += 1
        top = np.linalg.eigvalsh(curve)[-1]
        along = np.linalg.solve(curve + 1e-9 * max(top, 1e-300) * np.eye(k), miss) if top > 0 else np.zeros(k)
        fall = miss @ curve @ along
        if fall <= 1e-10 * (miss @ miss):  # nothing that is free can make it less
            done = True
            break
        size = 1.0
        while passes < GRADIENT_PASSES:
            tried = [*steps, Step(tuple(-size * root * along), tuple(slope))]
            there, passes = totals(tried), passes + 1
            if ((root * (there - targets)) ** 2).sum() <= miss @ miss - 2e-4 * size * fall:
                steps, now = tried, there
                break
            size /= 4
    return rate(), (now * budget).tolist(), done


def _solved(rows: DataFrame, targets: np.ndarray, least: float, budget: float, tolerance: float) -> tuple[np.ndarray, list[float]]:
    """The move whose totals meet the targets (shares of the budget), and those totals."""
    weighed = np.where(targets > 2e-9, targets, 1.0)  # a target of zero must not outweigh the others
    held, enough = RIDGE * weighed, tolerance / 10 * weighed

    def at(move: np.ndarray) -> tuple:
        value, totals, curve = _dual(rows, move, least, budget)
        return move, value + (held * move**2).sum() / 2 - targets @ move, totals + held * move - targets, totals, curve

    here, passes = at(np.zeros(len(targets))), 1
    while passes < PASSES and (np.abs(here[2]) > enough).any():
        move, value, slope, _, curve = here
        step = np.linalg.lstsq(curve + np.diag(held), -slope, rcond=None)[0]
        size = 1.0
        while passes < PASSES:
            there, passes = at(move + size * step), passes + 1
            # close to the end the value's last digits say nothing, the slope's do
            exhausted = abs(size * (slope @ step)) < 1e-9 * abs(value) and np.abs(there[2] / weighed).max() < np.abs(slope / weighed).max()
            if there[1] <= value + 1e-4 * size * (slope @ step) or exhausted:
                break
            size /= 2
            if size < 1e-6:
                return move, (here[3] * budget).tolist()
        else:
            break
        here = there
    return here[0], (here[3] * budget).tolist()


def mixing_rates(docs: DataFrame, weights: dict[str, float], label: str = "lang", key: str = "doc_id", text: str = "text",
                 budget: float | None = None, least: float = 0.0, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, domain, n_tokens, p, rate, copies, met.

    ``met`` says of all rows together whether the expected totals meet their targets. ``copies`` is the rate rounded up or down by a hash of the key, so its mean is the rate and a
    second run gives the same. Null labels and labels without a weight are no training rows but get
    memberships and rates; null texts have no tokens; rows that repeat a key get equal copies. Other
    columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    domains = sorted(weights)
    rows = stored(memberships(docs, domains, label, key, text, sample_rows), "memberships")
    rate, totals, targets = fit_rates(rows, [weights[d] for d in domains], budget, least)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    return rows.withColumn("rate", rate).withColumns({"copies": copies, "met": F.lit(meets(totals, targets))})


def mix(docs: DataFrame, weights: dict[str, float], label: str = "lang", key: str = "doc_id", text: str = "text",
        budget: float | None = None, least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, with all their columns.

    With ``least=1.0`` every row stays, and what is short is repeated. Null texts, null keys and rows that
    repeat a key are treated as by ``mixing_rates``; columns of any name are carried along; an empty
    table gives an empty one.
    """
    name, times = free_name(docs, "mix_key"), free_name(docs, "mix_copies")
    rates = mixing_rates(docs, weights, label, key, text, budget, least)
    # rows that are there once, nearly all of them in a mild mix, need not be looked up
    other = stored(rates.where("copies <> 1").groupBy("doc_id").agg(F.max("copies")).toDF(name, times), "mix-copies")
    joined = docs.join(small(other), F.col(key).eqNullSafe(F.col(name)), "left").withColumn(times, F.coalesce(times, F.lit(1)))
    repeated = joined.where(F.col(times) > 0).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.drop(name, times)
