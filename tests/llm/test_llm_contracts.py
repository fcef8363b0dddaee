"""Operators with a contract, against brute force over whole tables and over rows that are hard to get right."""

import collections
import hashlib
import math
import random
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flightlane.llm import exact_dedup, jaccard_join, katz, quality_rules, wavelet

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "Lorem ipsum dolor sit amet " * 4000
HARD = [
    (1, "A b c d e f"), (2, "a B c d e f"), (3, None), (4, ""), (5, " \t\n\x0b\x0c\r "), (6, "one two"), (7, "ONE two"),
    (8, "Été été x"), (9, LONG), (9, LONG), (None, "a b c d e f"), (None, None), (10, LONG + "end"),
    (11, "x"), (12, "a\x1cb c"), (13, "same words " * 60), (14, "中文 \U0001F600 <|endoftext|> don't"),
]


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(k, t, "x", i, "y") for i, (k, t) in enumerate(HARD)]
    # columns that clash with names the operators use inside
    return spark.createDataFrame(rows, "doc_id long, text string, hash string, row long, kept string").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def folded(text):
    return WORD.findall((text or "").translate(LOWER))


# --- exact dedup --------------------------------------------------------------------------


def expected_groups(rows):
    groups = collections.defaultdict(list)
    for key, text in rows:
        groups[(text or "").translate(LOWER)].append(key)
    out = collections.Counter()
    for text, keys in groups.items():
        top = max((k for k in keys if k is not None), default=None)
        for key in keys:
            out[key, top, len(keys), hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hash_of", [exact_dedup.content_hash, lambda c: F.substring(F.md5(c), 1, 1), lambda c: F.lit("all")])
@pytest.mark.parametrize("bound", [0, 1000])
def test_exact_groups_hold_equal_texts_whatever_the_hash(hard, hash_of, bound):
    got = exact_dedup.exact_groups(hard, hash_of=hash_of, broadcast_hashes=bound).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected_groups(HARD)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({(t or "").translate(LOWER) for _, t in HARD})  # one of each group, also of repeated rows
    assert all(r.doc_id == r.keep_id for r in kept)


def test_dedup_keeps_columns_and_one_of_repeated_rows(hard, none):
    left = exact_dedup.dedup(hard)
    assert left.columns == hard.columns
    keys = collections.Counter(r.doc_id for r in left.collect())
    assert keys[9] == 1 and keys[None] == 2 and keys[2] == 1 and keys[1] == 0
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.dedup(none).count() == 0


# --- LM scoring ---------------------------------------------------------------------------


def katz_by_hand(rows):
    docs = [(k, k is not None and zlib.crc32(str(k).encode()) % 10 == 0, [*folded(t), "\n"]) for k, t in rows]
    words, pairs = collections.Counter(), collections.Counter()
    for _, held_out, w in docs:
        if not held_out:
            words.update(w)
            pairs.update(zip(["\n", *w[:-1]], w))
    total = sum(words.values())
    shares = [katz.discounts([sum(1 for n in c.values() if n == r) for r in range(1, katz.DISCOUNTED + 2)]) for c in (words, pairs)]

    def share(n, of):
        return of[n] if n <= katz.DISCOUNTED else 1.0

    freed = sum(n * (1 - share(n, shares[0])) for n in words.values())
    mass = total if freed > 0 else total + 1
    unknown = (freed if freed > 0 else 1.0) / mass

    def word(w):
        return words[w] * share(words[w], shares[0]) / mass if w in words else unknown

    off, seen = collections.Counter(), collections.Counter()
    for (h, w), n in pairs.items():
        off[h] += n * (1 - share(n, shares[1]))
        seen[h] += word(w)

    def prob(h, w):
        if not words[h]:
            return word(w)
        count = words[h] + (off[h] <= 0)
        if (h, w) in pairs:
            return pairs[h, w] * share(pairs[h, w], shares[1]) / count
        return (off[h] if off[h] > 0 else 1.0) / count / (1 - seen[h]) * word(w)

    out = []
    for k, held_out, w in docs:
        base = sum(math.log10((words[x] + 0.1) / (total + 0.1 * (len(words) + 1))) for x in w)
        score = sum(math.log10(prob(a, b)) for a, b in zip(["\n", *w[:-1]], w))
        out.append((k, held_out, len(w), sum(x in words for x in w), total, base, score))
    return out, prob, words


@pytest.mark.parametrize("chars", [200, 10**7])
def test_scores_equal_those_of_a_model_in_memory(documents, hard, chars):
    for rows in (documents, hard):
        data = [(r.doc_id, r.text) for r in rows.collect()]
        expected, prob, words = katz_by_hand(data)
        got = katz.lm_scores(rows, block_chars=chars if rows is hard else 10 * chars).collect()
        order = lambda r: (r[0] is None, r[0] or 0, r[5])
        for a, b in zip(sorted(map(tuple, got), key=order), sorted(expected, key=order), strict=True):
            assert a[:5] == b[:5]
            assert a[5:] == pytest.approx(b[5:], rel=1e-9)
        for context in ["\n", *list(words)[:5]]:
            assert sum(prob(context, w) for w in words) + prob(context, "never seen") == pytest.approx(1, abs=1e-9)


def test_known_text_scores_higher_than_the_base(documents):
    rows = katz.lm_scores(documents).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_scores_of_no_or_only_held_out_rows(spark, none):
    assert katz.lm_scores(none).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    row = katz.lm_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)


# --- quality rules ------------------------------------------------------------------------


def counts_by_hand(text):
    text = text or ""
    w = WORD.findall(text)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + o for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for o in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_counts_of_whole_texts(documents, hard, none):
    for rows in (documents, hard):
        texts = collections.Counter((r.doc_id, *counts_by_hand(r.text)) for r in rows.collect())
        got = quality_rules.quality(rows).collect()
        assert collections.Counter(tuple(r)[:6] for r in got) == texts
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert r.kept == (not r.base_failed and r.failed_rule is None)
    assert quality_rules.quality(none).count() == 0


def test_cascade_verdict_does_not_depend_on_the_order(documents):
    rows, rules = quality_rules.with_text_counts(documents), quality_rules.standard_rules()
    ahead, back = (rows.select("doc_id", quality_rules.cascade(x).isNull().alias("ok")) for x in (rules, rules[::-1]))
    assert sorted(ahead.collect()) == sorted(back.collect())
    ordered = quality_rules.order_rules(quality_rules.with_text_counts(quality_rules.rule_sample(documents, 50)), rules)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)
    assert not quality_rules.order_rules(quality_rules.with_text_counts(documents.limit(0)), [])


def test_a_dear_rule_that_rejects_little_comes_last(documents):
    """What a rule reads is part of its cost, and a job's start is not."""
    def prepare(rows):
        text = F.coalesce("text", F.lit(""))
        for _ in range(40):
            text = F.sha2(F.concat(text, F.col("text")), 512)
        return rows.withColumns({"digest": text, "size": F.length("text")})

    dear = quality_rules.Rule("dear", F.col("digest") < "01")
    cheap = [quality_rules.Rule("none", F.col("doc_id") < 0), quality_rules.Rule("long", F.col("size") > 2000), quality_rules.Rule("most", F.col("size") > 100)]
    sample = quality_rules.rule_sample(documents.where("text is not null").select("doc_id", "text"))
    flags = [F.coalesce(r.reject, F.lit(False)) for r in [dear, *cheap]]
    costs = quality_rules._costs(sample.coalesce(1), flags, prepare)
    assert costs[0] > 5 * max(costs[1:])
    rejecting = [dear, *cheap[1:]]
    assert [r.name for r in quality_rules.order_rules(sample, rejecting, prepare)][0] == "most"
    assert [r.name for r in quality_rules.order_rules(sample, [dear, cheap[2]], prepare)] == ["most", "dear"]
    assert [r.name for r in quality_rules.order_rules(sample.limit(0), rejecting, prepare)] == ["dear", "long", "most"]


def test_later_rules_are_not_evaluated(spark):
    rules = [quality_rules.Rule("first", F.col("x") > 0), quality_rules.Rule("second", F.raise_error(F.lit("evaluated")).cast("boolean"))]
    assert spark.range(1, 3).toDF("x").select(quality_rules.cascade(rules)).distinct().first()[0] == "first"


def test_good_documents_are_kept_and_junk_goes(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality_rules.quality(documents).join(labels, "doc_id").where("n_words >= 50").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = dict(map(tuple, rows))
    assert share[1] > 0.97 and share[0] < 0.2


# --- token shards -------------------------------------------------------------------------


def test_shards_hold_the_ids_of_the_library(spark, documents, hard, none):
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(file)
    for rows in (documents, hard):
        expected, start = [], 0
        ordered = sorted(((r.doc_id, r.text) for r in rows.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        for key, text in ordered:
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
            expected.append((key, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        got = sorted(wavelet.token_output(rows, file).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == [k for k, _, _ in expected]
        assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter(expected)
        assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert wavelet.token_output(none, file).count() == 0


def test_files_of_lost_attempts_do_not_count(spark, documents, tmp_path):
    folder, file = str(tmp_path / "out"), public_tokenizers.path("word_bpe_49k.json")
    listed = wavelet.write_token_shards(documents, folder, file, shard_tokens=5000)
    before = sorted(wavelet.read_token_shards(spark, folder).collect())
    name = listed.first().file
    (tmp_path / "out/shards" / f"{name}.again").write_bytes((tmp_path / "out/shards" / name).read_bytes())
    assert sorted(wavelet.read_token_shards(spark, folder).collect()) == before
    assert listed.count() > 8


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 5000])
def test_wavelet_matrix_answers_access_count_and_places(n):
    dice = np.random.default_rng(n)
    tokens = (dice.zipf(1.3, n) % 49_000).astype(np.uint16)
    _, _, matrix = wavelet.open_shard(wavelet.shard_bytes(np.zeros(1, np.int64), np.zeros(1, bool), np.array([n], np.uint32), tokens))
    assert matrix.tokens().tolist() == tokens.tolist()
    for i in dice.integers(0, n, 30).tolist() if n else []:
        token, places = int(tokens[i]), np.flatnonzero(tokens == tokens[i])
        k = int(dice.integers(0, len(places)))
        assert (matrix.access(i), matrix.count(token), matrix.rank(token, i), matrix.select(token, k)) == (
            token, len(places), int((tokens[:i] == token).sum()), places[k])
    assert matrix.count(60_000) == 0
    with pytest.raises(IndexError):
        matrix.select(60_000, 0)


def test_a_shard_cut_short_is_refused():
    data = wavelet.shard_bytes(np.zeros(1, np.int64), np.zeros(1, bool), np.array([3], np.uint32), np.arange(3, dtype=np.uint16))
    with pytest.raises(ValueError):
        wavelet.open_shard(data[:-1])


# --- n-gram Jaccard join ------------------------------------------------------------------


def components_by_hand(rows, size=4, threshold=85):
    sets = []
    for _, text in rows:
        w = folded(text)
        sets.append(frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset())
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= threshold * len(a | sets[j]):
                up[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return collections.Counter((key, len(s), least.get(top(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets)))


def edited(spark, copies=60):
    dice = np.random.default_rng(5)
    base = [f"w{i}" for i in dice.integers(0, 400, 120)]
    rows = [(i, f"only {i} here to be read by me") for i in range(1000, 1040)]
    for i in range(copies):
        words = list(base)
        for at in dice.integers(0, 120, int(dice.integers(0, 5))):
            words[at] = f"x{dice.integers(0, 9)}"
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("settings", [{}, {"block_chars": 300, "tree_shingles": 200}, {"threshold": 50, "size": 2}, {"threshold": 100}])
def test_components_are_those_of_all_pairs(spark, documents, hard, none, settings):
    tables = [hard, edited(spark)] + [documents] * (not settings)
    for rows in tables:
        expected = components_by_hand([(r.doc_id, r.text) for r in rows.collect()], settings.get("size", 4), settings.get("threshold", 85))
        assert collections.Counter(map(tuple, jaccard_join.jaccard_components(rows, **settings).collect())) == expected
    if not settings:
        assert jaccard_join.jaccard_components(none).count() == 0


def test_what_a_task_holds_does_not_grow_with_a_group(spark, monkeypatch):
    join = jaccard_join._join_slot

    def bounded(threshold):
        of_slot = join(threshold)

        def checked(group):
            held = sum(group["n"].to_pylist())
            assert held <= 16_000, held  # two pieces, and as much again for their uneven hashes
            return of_slot(group)

        return checked

    monkeypatch.setattr(jaccard_join, "_join_slot", bounded)
    rows = edited(spark, 400)
    expected = components_by_hand([(r.doc_id, r.text) for r in rows.collect()], 4, 85)
    assert collections.Counter(map(tuple, jaccard_join.jaccard_components(rows, tree_shingles=4000).collect())) == expected


def test_one_of_each_component_stays_with_its_columns(hard):
    left = jaccard_join.keep_one(hard)
    assert left.columns == hard.columns
    assert sorted(r.doc_id for r in left.where("doc_id is not null").collect()) == [1, 3, 4, 5, 6, 8, 9, 9, 10, 11, 12, 13, 14]


def test_tree_finds_a_link_of_every_linked_pair():
    dice = np.random.default_rng(3)
    for _ in range(60):
        base = dice.choice(300, 40, replace=False)
        sets = {tuple(sorted({*dice.choice(base, int(dice.integers(25, 41)), replace=False), *dice.choice(300, 3)})) for _ in range(25)}
        sets = [np.array(s, np.uint64) for s in sorted(sets)]
        df = collections.Counter(x for s in sets for x in s.tolist())
        links = jaccard_join.tree_links(sets, [np.array([df[x] for x in s.tolist()], np.uint32) for s in sets], 70)
        rows = [(i, " ".join(map(str, s.tolist()))) for i, s in enumerate(sets)]
        classes = jaccard_join.Classes(len(sets))
        for a, b in links:
            x, y = set(sets[a].tolist()), set(sets[b].tolist())
            assert 100 * len(x & y) >= 70 * len(x | y)
            classes.join(a, b)
        expected = components_by_hand(rows, 1, 70)
        assert collections.Counter((i, len(s), classes.of(i)) for i, s in enumerate(sets)) == expected


def test_ids_of_odd_letters_are_the_librarys():
    path = public_tokenizers.path("word_bpe_49k.json")
    words = wavelet.WordIds(open(path).read())
    letters = [c for c in map(chr, range(0x80, 0x3000)) if c.isalnum() and (len(c.lower()) != 1 or unicodedata.normalize("NFD", c.lower()) != c)]
    made = random.Random(5)
    texts = [c + "." for c in letters] + ["".join(made.choice(["\u0130", "i", "I", ".", ",", " ", "\u0307", "2", "'", made.choice(letters)])
                                                  for _ in range(made.randint(1, 8))) for _ in range(5000)]
    for text, ids in zip(texts, wavelet.encoded(texts, words, 1)):
        assert ids.tolist() == [*words.tokenizer.encode(text, add_special_tokens=False).ids, 1], text
