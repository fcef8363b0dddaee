"""Quality rules as a short-circuit cascade, ordered by what a sample shows of cost and selectivity."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.llm.common import free_name, whole, words
from flightlane.session import stored

#: Rows that the order of the rules is estimated on, on average; the order never changes a verdict.
SAMPLE_ROWS = 1000
#: How often a job that times a rule repeats the rows of the sample; the next where a rule does not stand out yet.
COPIES = (2, 16, 128)


@dataclass(frozen=True)
class Rule:
    """Rejects a document where ``reject`` is true; null is no rejection."""

    name: str
    reject: Column


def with_text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds _words, _lines and the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long).

    A null text counts as empty: all counts are zero. Each count is over the whole text; memory is
    bounded by the longest text.
    """
    whole_text = whole(text)
    n = F.size("_words")
    starts = F.greatest(n - 2, F.lit(0))
    lines = F.filter(F.split(whole_text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    windows = F.arrays_zip(F.slice("_words", 1, starts).alias("a"), F.slice("_words", 2, starts).alias("b"),
                           F.slice("_words", 3, starts).alias("c"))
    placed = F.arrays_zip(F.col("_windows").alias("w"), F.transform("_windows", lambda _, i: i).alias("at"))
    return (
        docs.withColumns({"_words": words(whole_text), "_lines": lines})
        .withColumn("_windows", windows)
        .withColumn("_sorted", F.sort_array(placed))
        .withColumn("_repeats", _repeated_starts("_sorted"))
        .withColumns({
            "n_words": n.cast("long"),
            "word_chars": F.length(F.translate(whole_text, " \t\n\x0b\f\r", "")).cast("long"),
            "n_symbols": (F.length(whole_text) - F.length(F.translate(whole_text, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _covered("_repeats"),
        })
        .drop("_windows", "_sorted", "_repeats")
    )


def _repeated_starts(name: str) -> Column:
    """Where windows start that occur twice or more: equal windows are neighbours once sorted."""
    s, last = F.col(name), F.size(name) - 1

    def repeated(x, i):
        before = (i > 0) & (F.get(s, i - 1)["w"] == x["w"])
        return before | ((i < last) & (F.get(s, i + 1)["w"] == x["w"]))

    return F.sort_array(F.transform(F.filter(s, repeated), lambda x: x["at"]))


def _covered(name: str) -> Column:
    """How many words lie in the three-word windows that start at the given sorted places."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(-1).alias("end"))
    return F.aggregate(
        name, start,
        lambda done, at: F.struct((done["total"] + at + 2 - F.greatest(done["end"], at - 1)).alias("total"), (at + 2).alias("end")),
        lambda done: done["total"])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def standard_rules(text: str = "text") -> list[Rule]:
    """Rules over a table of ``with_text_counts``; whole numbers only, so that no rounding decides."""
    n, chars = F.col("n_words"), F.col("word_chars")
    whole_text = whole(text)
    return [
        Rule("too_short", n < 50),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 50 * n),
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("word_length", (2 * chars < 5 * n) | (chars > 12 * n)),
        Rule("duplicate_lines", 10 * F.col("n_dup_lines") > 4 * F.size("_lines")),
        Rule("shouting", 2 * F.regexp_count(whole_text, F.lit("[!?]")) > n),
        Rule("capitals", 10 * F.regexp_count(whole_text, F.lit("\\p{Lu}")) > 3 * chars),
        Rule("few_different_words", 10 * F.size(F.array_distinct("_words")) < n),
    ]


def rule_sample(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``sample_rows`` rows of a table, drawn before anything is computed on it."""
    return docs.sample(min(1.0, sample_rows / max(1, docs.count())), seed=7)


def order_rules(sample: DataFrame, rules: Iterable[Rule], prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> list[Rule]:
    """The rules by rejections per second among what the rules before them let through.

    ``prepare`` adds the columns that rules read. A rule costs what its own work takes: that of
    the columns it reads (the others are pruned) and its own, without what any job takes. Which rules
    reject together is one count per pattern of verdicts. An empty sample leaves the order as given.
    """
    rules = list(rules)
    # about SAMPLE_ROWS rows, in one task, so that a job's time is its work
    sample = stored(sample, "rule-sample").coalesce(1)
    flags = [F.coalesce(r.reject, F.lit(False)) for r in rules]
    names = [f"r{i}" for i in range(len(rules))]
    verdicts = prepare(sample).select(*(f.alias(n) for f, n in zip(flags, names)))
    patterns = [(row[:-1], row[-1]) for row in verdicts.groupBy(*names).count().collect()] if rules else []
    if not patterns:
        return rules
    left, order = dict(enumerate(_costs(sample, flags, prepare))), []
    while left:
        best = max(left, key=lambda i: sum(n for hit, n in patterns if hit[i]) / left[i])
        order.append(rules[best])
        patterns = [(hit, n) for hit, n in patterns if not hit[best]]
        del left[best]
    return order


def _costs(sample: DataFrame, flags: list[Column], prepare: Callable[[DataFrame], DataFrame]) -> list[float]:
    """Seconds that each of the flags takes for the sample once, a tenth of an empty job's share at least.

    The job repeats the sample's rows, so that a rule's work outgrows the start of a job, and a job
    over as many rows without a rule is taken off.
    """
    copy = free_name(sample, "copy")

    def seconds(copies: int, flag: Column) -> float:
        rows = prepare(sample.withColumn(copy, F.explode(F.sequence(F.lit(1), F.lit(copies)))))
        took = []
        for _ in range(2):  # the first run also compiles
            start = time.perf_counter()
            rows.agg(F.count_if(flag)).collect()
            took.append(time.perf_counter() - start)
        return min(took)

    empty: dict[int, float] = {}
    costs = []
    for flag in flags:
        for copies in COPIES:
            if copies not in empty:
                empty[copies] = seconds(copies, F.col(copy) < 0)
            took = seconds(copies, flag)
            if took >= 2 * empty[copies]:
                break
        costs.append(max(took - empty[copies], empty[copies] / 10) / copies)
    return costs


def cascade(rules: Iterable[Rule]) -> Column:
    """The name of the first rule that rejects, null if none does; later rules are not evaluated."""
    verdict = None
    for rule in rules:
        reject = F.coalesce(rule.reject, F.lit(False))
        verdict = F.when(reject, rule.name) if verdict is None else verdict.when(reject, rule.name)
    return F.lit(None).cast("string") if verdict is None else verdict


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, counts, base_failed, failed_rule, kept.

    Null and empty texts have no words, so they fail. Repeated rows and null keys are judged like
    any other; other columns of ``docs`` are ignored; an empty table gives an empty result. The
    counts are part of the result, so the cascade saves the work of rules beyond them only.
    """
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = with_text_counts(texts)
    order = order_rules(rule_sample(texts), standard_rules(), with_text_counts)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), cascade(order).alias("failed_rule"),
    ).withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull())
