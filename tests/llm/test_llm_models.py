"""Tokenizers, toxicity, page texts, mixing, helpers and the pipeline."""

import collections
import html
import re
import struct
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from flightlane.llm import exact_dedup, mixing, registered, sentencepiece_fst, style_tree, token_counts, toxicity
from flightlane.llm.components import components
from flightlane.llm.packing import bucket_cuts, pack, pack_sorted, unpack, unpack_sorted
from flightlane.session import stored
from tests_compare import compared

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
HARD = ["", " ", "a", "Hello  world \n été 中文\t\U0001F600 x", "   lead and trail   ", "▁ ▁▁x", "\x00▁", "a" * 40, " " * 30 + "x",
        "<s> </s> <unk> <0x0A>", "J̌ \xa0nbsp　", "x" * 5000, "e.g. 1,2,3 ... --- !!! (a)b[c]", "\n\n\na\r\nb", "don't I'LL"]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return HARD + [r.text for r in documents.collect()]


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def number(n):
    out = b""
    while True:
        out, n = out + bytes([n & 127 | (128 if n > 127 else 0)]), n >> 7
        if not n:
            return out


def unigram_model(score, byte_fallback=True):
    """A unigram model file of the same pieces with scores of another kind."""
    out = b""
    for piece, old, kind in sentencepiece_fst.Model(sentencepiece_fst.model_bytes(MODEL)).pieces:
        if kind == sentencepiece_fst.BYTE and not byte_fallback:
            continue
        body = b"\x0a" + number(len(piece.encode())) + piece.encode() + b"\x15" + struct.pack("<f", score(old)) + b"\x18" + number(kind)
        out += b"\x0a" + number(len(body)) + body
    trainer = b"\x18\x01" + (b"\x98\x02\x01" if byte_fallback else b"")
    normalizer = b"\x0a\x08identity\x18\x01\x20\x00\x28\x01"
    return out + b"\x12" + number(len(trainer)) + trainer + b"\x1a" + number(len(normalizer)) + normalizer


# --- SentencePiece ------------------------------------------------------------------------


def test_merges_equal_the_library_and_decode_to_the_text(texts):
    transducer = sentencepiece_fst.Transducer(sentencepiece_fst.model_bytes(MODEL))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in texts:
        ids = transducer.encode(text)
        assert ids == library.encode(text)
        assert transducer.decode(ids) == library.decode(ids)
    for text in texts[len(HARD):]:
        assert transducer.decode(transducer.encode(text)) == text


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_scores_give_the_path_of_least_weight(texts, byte_fallback):
    data = unigram_model(lambda s: -float(np.float32(np.log1p(-min(s, 0.0)))), byte_fallback)
    transducer, library = sentencepiece_fst.Transducer(data), sentencepiece.SentencePieceProcessor(model_proto=data)

    def weight(ids):
        return sum(library.get_score(i) if not library.is_byte(i) else 0.0 for i in ids)

    equal = 0
    for text in texts:
        ids, other = transducer.encode(text), library.encode(text)
        equal += ids == other  # the library adds in single precision, so near ties can differ
        assert weight(ids) >= weight(other) - 1e-2
        if byte_fallback:
            assert transducer.decode(ids) == library.decode(other)
    assert equal >= 0.95 * len(texts)


def test_every_short_string_has_the_best_of_all_segmentations():
    transducer = sentencepiece_fst.Transducer(unigram_model(lambda s: -float(np.log1p(-min(s, 0.0)))))

    def best(text):
        if not text:
            return 0.0
        return max(transducer.scores.get(text[:i], transducer.penalty if i == 1 else -1e9) + best(text[i:]) for i in range(1, len(text) + 1))

    for word in ("▁there", "▁Ouvert.", "▁xyzzyq", "▁éé", "▁a\U0001F600b"):
        path = transducer._path_of_scores(word)
        assert "".join(transducer.texts[p] for p in path) == word
        assert sum(transducer.scores.get(transducer.texts[p], transducer.penalty) for p in path) == pytest.approx(best(word))


def test_documents_are_encoded_and_decoded(spark, none):
    rows = spark.createDataFrame([(i, t, 0, "c") for i, t in enumerate(HARD)] + [(None, None, 1, "c"), (3, "a", 2, "c"), (3, "a", 2, "c")],
                                 "doc_id long, text string, ids int, decoded string")
    got = sentencepiece_fst.encode_documents(rows, MODEL, decoded=True).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = collections.Counter((r.doc_id, tuple(library.encode(r.text or ""))) for r in rows.collect())
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == expected
    assert all(r.n_ids == len(r.ids) and r.decoded == library.decode(r.ids) for r in got)
    encoded = sentencepiece_fst.encode_documents(rows, MODEL)
    again = sentencepiece_fst.decode_documents(encoded, MODEL)
    assert again.columns == ["doc_id", "n_ids", "ids", "decoded"] and encoded.columns == ["doc_id", "n_ids", "ids"]
    assert sorted(r.decoded for r in again.collect()) == sorted(r.decoded for r in got)
    assert sentencepiece_fst.encode_documents(none, MODEL).count() == 0


# --- token counts -------------------------------------------------------------------------


def test_counts_equal_those_of_the_least_path(spark, texts, none):
    counter = token_counts.TrieCounter(sentencepiece_fst.model_bytes(MODEL))
    scores = counter.scores
    transducer = sentencepiece_fst.Transducer(unigram_model(lambda s: -float(np.log1p(-min(s, 0.0)))))
    assert max(abs(transducer.scores[p] - s) for p, s in scores.items() if p in transducer.scores and s > -30) < 1e-5
    transducer.model.pieces = [(p, scores.get(p, s), k) for p, s, k in transducer.model.pieces]  # in double precision
    transducer.penalty = counter.unknown
    expected = [len(transducer.encode(t)) for t in texts]
    assert [n for _, n in counter.counts(texts)] == expected
    rows = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, None, 1), (0, "", 1)], "doc_id long, text string, n_tokens int")
    got = token_counts.token_counts(rows.repartition(3), MODEL).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.n_tokens) for r in got) == collections.Counter(
        [(i, len(t), n) for i, (t, n) in enumerate(zip(texts, expected))] + [(None, 0, 0), (0, 0, 0)])
    assert token_counts.token_counts(none, MODEL).count() == 0


def test_a_small_trie_gives_the_same_counts(texts, monkeypatch):
    data = sentencepiece_fst.model_bytes(MODEL)
    expected = list(token_counts.TrieCounter(data).counts(texts))
    monkeypatch.setattr(token_counts, "WORDS_KEPT", 50)
    monkeypatch.setattr(token_counts, "TRIE_CHARS", 500)
    assert list(token_counts.TrieCounter(data).counts(texts)) == expected


# --- toxicity -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trained(spark):
    dice = np.random.default_rng(2)
    plain = ["".join(dice.choice(list("aeiourstln"), int(n))) for n in dice.integers(2, 9, 1500)]
    rows, labels = [], []
    for i in range(900):
        words = list(dice.choice(plain, int(dice.integers(60, 140))))
        toxic = i % 5 == 0
        if toxic:
            for at in dice.integers(0, len(words), 6):
                words[at] = dice.choice(["wretched", "blockhead", "vermin"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic), 1))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "wretched " * 50, "x"), (1002, "vermin " * 20_000, "x"), (7, rows[7][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4)
    known = spark.createDataFrame(labels + [(5000, 1, 1), (None, 1, 1), (3, None, 1)], "doc_id long, toxic int, quality int")
    return docs, known, toxicity.fit(docs, known)


def test_held_out_rows_are_told_apart(trained):
    docs, known, detector = trained
    rows = toxicity.toxicity(docs, detector)
    assert rows.count() == docs.count()
    held = rows.join(known.where("toxic is not null"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in held)
    assert len(held) > 100 and right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.collect())


def test_scores_follow_from_the_text_alone(spark, trained):
    docs, _, detector = trained
    other = docs.select((F.col("doc_id") + 10_000).alias("doc_id"), "text").where("text is not null")
    a = collections.Counter(round(r.score, 9) for r in toxicity.toxicity(docs.where("text is not null"), detector).collect())
    assert a == collections.Counter(round(r.score, 9) for r in toxicity.toxicity(other, detector).collect())
    empty = toxicity.toxicity(docs.where("doc_id in (1000, 1001)"), detector).collect()
    assert len({r.score for r in empty}) == 1 and empty[0].predicted == 0


def test_toxic_rows_go_with_their_columns_kept(trained, none):
    docs, known, _ = trained
    left = toxicity.without_toxic(docs, known)
    assert left.schema == docs.schema
    keys = {r.doc_id for r in left.collect()}
    assert len(keys & {r.doc_id for r in known.where("toxic = 0").collect()}) > 690
    assert len(keys & {r.doc_id for r in known.where("toxic = 1").collect()}) < 10
    assert toxicity.without_toxic(none, known).count() == 0


def test_without_labels_every_score_is_one_half(trained):
    docs, known, _ = trained
    scores = toxicity.toxicity(docs, toxicity.fit(docs, known.limit(0))).select("score").distinct().collect()
    assert [r.score for r in scores] == [0.5]


# --- page texts ---------------------------------------------------------------------------


def test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in style_tree.main_texts(pages).collect()}
    for page in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", page.html, re.S)[1].replace("<br>", "\n")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        text = "\n\n".join(b for b in blocks if b)
        assert (got[page.page_id].text, got[page.page_id].n_chars) == (text, len(text))


def texts_of(page, keep=lambda node: not node.labelled):
    return [t for node, t in style_tree.parse(page)[0] if keep(node)]


@pytest.mark.parametrize(("page", "expected"), [
    (None, []), ("", []), ("just text", ["just text"]), ("a &lt; b &amp;amp; &eacute;&nbsp;x", ["a < b &amp; é x"]),
    ("<p>a<p>b<br>c</p>d", ["a", "b c", "d"]), ("<ul><li>a<li>b</ul>", ["a", "b"]),
    ("<div><p>a <b>b</b>c</div>d", ["a bc", "d"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("<script>if (a<b) '</p>'</script><style>p{}</style>x<!-- <p>no</p> -->y", ["xy"]),
    ("<nav><p>menu</p></nav><p>a</p><aside>b</aside><form>c</form><footer>d</footer>", ["a"]),
    ("<div class='post-comments'><p>c</p></div><div id=mainText>a</div><div class=\"ad banner\">b</div>", ["a"]),
    ("<article><header><h1>T</h1></header><p>a</p><div class=comments>c</div></article><header>H</header>", ["T", "a"]),
    ("<p>a</b></i></div>b", ["ab"]), ("<p title='x>y'>a</p><p title=\"q>a\">b", ["a", "b"]), ("<p>a<", ["a<"]), ("<p>a<b", ["a"]),
    ("<head><title>t</title><meta x></head><body>a", ["a"]), ("<P CLASS=Nav>n</P><P>a</P>", ["a"]), ("a < b <p>c", ["a < b", "c"]),
])
def test_blocks_of_awkward_pages(page, expected):
    assert texts_of(page) == expected


@pytest.mark.parametrize(("page", "expected"), [
    ("<html><head><title>t</title><article><p>text</p></article>", ["text"]),
    ("<head><title>t</title><style>p{}</style><script>'</head><p>'</script><p>text</p>", ["text"]),
    ("<head><noscript><link x></head><body><p>text</p></body>", ["text"]), ("<head><title>t<body><p>text</p></body>", ["text"]),
    ("<head class=nav><p>text", ["text"]),
    *((f"<body><div><{tag}><b>x</b></div><p>text</p><div><{tag}>y</{tag}>z</div></body>", ["text", "z"]) for tag in ("noscript", "svg", "select", "object", "canvas")),
    *((f"<body><{tag}><b>x</b><article><p>text</p></article></body>", ["text"]) for tag in ("noscript", "svg", "select", "object", "canvas")),
    ("<object><p>x</p><object><p>y</p></object><script>'</object>'</script></object><p>text", ["text"]),
    ("<p>text<script>var x = '</p><p>no'", ["text"]), ("<div><noscript><div>x</div></noscript>text</div>", ["text"]),
    ("<p>a <select><option>b<option>c</select> d</p>", ["a d"]),
])
def test_raw_elements_without_an_end_leave_the_rest_of_the_page(page, expected):
    assert [t for _, t in style_tree.parse(page)[0]] == expected


def test_what_a_site_repeats_goes_and_what_a_page_has_stays(spark, none):
    dice = np.random.default_rng(1)
    word = lambda n: " ".join(f"w{x}" for x in dice.integers(0, 10_000, n))
    pages = [(i, f"https://big.example/{i}", f"<div class=x1><p>Same line on every page</p></div><div class=c{i}><p>{word(30)}</p></div>", 1) for i in range(80)]
    pages += [(100 + i, f"http://tiny{i}.example/", f"<div class=x1><p>Same line on every page</p></div><div class=c><p>{word(30)}</p></div>", 1) for i in range(30)]
    pages += [(200, None, "<article><p>a</p></article>", 1), (None, "x", None, 1), (201, "http://big.example", "", 1)]
    got = style_tree.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string, site int").repartition(4)).collect()
    assert len(got) == len(pages)
    for r in got:
        if r.page_id is not None and r.page_id < 200:
            assert r.text.startswith("w") and "Same" not in r.text and r.n_chars == len(r.text)
        else:
            assert r.text == ("a" if r.page_id == 200 else "")
    assert style_tree.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_small_sites_are_judged_by_their_own_pages_too(spark):
    """A value moves with the number of pages, and no number of them switches it."""
    def pages(site, n, line):
        return [(None, f"http://{site}.example/", f"<div class=x><p>{line(i)}</p></div><div class=c><p>{own_text(1000 * len(site) + i)}</p></div>") for i in range(n)]

    rows = pages("other", 60, lambda i: f"line {i} of its own")
    for n in (1, 2, 5, 15, 19, 20, 21, 40):
        rows += pages("s" * n, n, lambda i: "Same line")
    trees = style_tree.style_trees(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4))
    worth = {r.site.count("s"): r.importance for r in trees.where("path = '/div.x' and site like 's%'").collect()}
    common, = (r.importance for r in trees.where("path = '/div.x' and site = '*'").collect())
    for n, value in worth.items():
        own = 1.0 if n == 1 else 0.0
        assert abs(value - (n * own + style_tree.PRIOR_PAGES * common) / (n + style_tree.PRIOR_PAGES)) < 1e-9
    sizes = sorted(worth)[1:]
    assert [worth[n] for n in sizes] == sorted((worth[n] for n in sizes), reverse=True) and worth[15] < style_tree.THRESHOLD
    assert trees.where("path = '/div.c' and importance < 0.9").count() == 0


def test_copies_of_an_article_on_one_site_keep_it(spark):
    pages = spark.createDataFrame([(i, "http://a.example/", "<nav>m</nav><article><p>Equal on all.</p></article>") for i in range(50)], "page_id long, url string, html string")
    assert {r.text for r in style_tree.main_texts(pages).collect()} == {"Equal on all."}


def site_texts(spark, pages):
    """The texts of pages of one site, in their order."""
    rows = spark.createDataFrame([(i, f"http://a.example/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in sorted(style_tree.main_texts(rows.repartition(4)).collect(), key=lambda r: r.page_id)]


def own_text(i, n=30):
    return " ".join(f"w{i * n + k}" for k in range(n))


@pytest.mark.parametrize(("start", "end"), [
    ("<div class='layout has-sidebar'>", "</div>"), ("<div id='page' class='header-fixed'><div class=c>", "</div></div>"), ("<form id=f>", "</form>"),
    ("<div class='layout has-sidebar'><article>", "</article></div>"), ("<div class=search-page><main>", "</main></div>")])
@pytest.mark.parametrize("n", [40, 6])
def test_a_wrapper_with_a_labelled_name_keeps_its_text(spark, start, end, n):
    pages = [f"<body>{start}<nav>Home</nav><div class=ad>buy {i}</div><h2>t{i}</h2><p>{own_text(i)}</p><footer>Imprint</footer>{end}</body>" for i in range(n)]
    assert site_texts(spark, pages) == [f"t{i}\n\n{own_text(i)}" for i in range(n)]


def test_entropy_alone_finds_what_has_no_label(spark):
    line = "<div class=x1><p>Same line</p></div>"
    pages = [f"<body>{line}<div class=c><p>{own_text(i)}</p></div><div class=x2><p>Same end</p></div></body>" for i in range(40)]
    assert site_texts(spark, pages) == [own_text(i) for i in range(40)]
    pages = [f"<main>{line}<p>{own_text(i)}</p></main><aside><article>Card {i}</article></aside>" for i in range(40)]
    assert site_texts(spark, pages) == [own_text(i) for i in range(40)]


@pytest.mark.parametrize(("before", "behind"), [("\ufeff", ""), ("", "stray line"), ("x\ufeff", "\nstray line")])
@pytest.mark.parametrize("n", [40, 6])
def test_text_outside_elements_is_judged_for_itself(spark, before, behind, n):
    pages = [f"{before * (i > 0)}<!DOCTYPE html><html><body><article><p>{own_text(i)}</p></article></body></html>{behind * (i > 0)}" for i in range(n)]
    assert site_texts(spark, pages) == [own_text(i) for i in range(n)]


# --- mixing -------------------------------------------------------------------------------


def projected_gradient(tokens, p, weights, least, iterations):
    rates = np.full(len(tokens), max(1.0, least))
    now = (tokens[:, None] * p * rates[:, None]).sum(0)
    shares = np.array(weights) / sum(weights)
    targets = shares * (now / shares).max()
    size = 1 / (now / targets).max()
    for _ in range(iterations):
        rates = np.maximum(least, rates - size * (p @ ((now - targets) / targets)))
        now = (tokens[:, None] * p * rates[:, None]).sum(0)
    return rates, now, targets


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_rates_are_those_of_the_gradient_steps(spark, least):
    dice = np.random.default_rng(4)
    p = dice.dirichlet([0.3, 0.3, 0.3], 400)
    tokens = dice.integers(0, 300, 400)
    rows = spark.createDataFrame([(i, int(t), q.tolist()) for i, (t, q) in enumerate(zip(tokens, p))], "doc_id long, n_tokens long, p array<double>")
    rate, now, targets = mixing.fit_rates(rows, [0.6, 0.3, 0.1], least=least, iterations=25)
    expected, totals, goal = projected_gradient(tokens, p, [0.6, 0.3, 0.1], least, 25)
    got = [r.r for r in rows.orderBy("doc_id").select(rate.alias("r")).collect()]
    assert got == pytest.approx(expected.tolist(), rel=1e-6, abs=1e-6)
    assert now == pytest.approx(totals.tolist(), rel=1e-6) and targets == pytest.approx(goal.tolist())
    assert min(got) >= least


def test_expected_tokens_meet_the_targets_even_where_a_domain_shrinks(spark):
    dice = np.random.default_rng(6)
    p = np.eye(3)[dice.integers(0, 3, 300)] * 0.9 + 0.1 / 3
    rows = spark.createDataFrame([(i, 100, q.tolist()) for i, q in enumerate(p)], "doc_id long, n_tokens long, p array<double>")
    _, now, targets = mixing.fit_rates(rows, [0.5, 0.25, 0.25], budget=9000.0, iterations=200)
    assert now == pytest.approx(targets, rel=1e-3) and sum(targets) == pytest.approx(9000)


def test_memberships_find_the_language_and_copies_follow_the_rates(spark, documents):
    rows = stored(mixing.mixing_rates(documents, {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}), "rates")
    assert rows.count() == documents.count()
    best = rows.where("n_tokens > 20").collect()
    domains = ["de", "en", "es", "fr"]
    assert sum(domains[int(np.argmax(r.p))] == r.domain for r in best) > 0.9 * len(best)
    assert all(abs(sum(r.p) - 1) < 1e-9 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows.collect())


def test_mixing_of_hard_rows(spark, none):
    weights = {"a": 0.7, "b": 0.3, "c": 0.0}
    rows = spark.createDataFrame([(1, "x y", "a", 1), (2, "z w " * 30_000, "b", 1), (3, None, "a", 1), (None, "x", None, 1), (4, "", "other", 1), (1, "x y", "a", 1)],
                                 "doc_id long, text string, lang string, copies int")
    got = mixing.mixing_rates(rows, weights).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 1), (1, 2), (1, 2), (2, 60_000), (3, 0), (4, 0)]
    assert all(r.rate >= 0 and abs(sum(r.p) - 1) < 1e-9 for r in got)
    mixed = mixing.mix(rows, weights, least=1.0)
    assert mixed.columns == rows.columns
    assert {r.doc_id for r in mixed.collect()} == {1, 2, 3, 4, None}
    assert mixing.mixing_rates(none, weights).count() == 0 and mixing.mix(none, weights).count() == 0


@pytest.mark.parametrize(("counts", "least", "soft"), [([980, 10, 8, 2], 1.0, 0.0), ([334, 333, 332, 1], 0.0, 0.05)])
def test_rare_domains_meet_their_targets(spark, counts, least, soft):
    p = np.repeat(np.eye(4), counts, axis=0) * (1 - soft) + soft / 4
    rows = spark.createDataFrame([(i, 100, q.tolist()) for i, q in enumerate(p)] + [(-1, 0, [0.25] * 4)], "doc_id long, n_tokens long, p array<double>")
    rate, now, targets = mixing.fit_rates(rows, [0.55, 0.17, 0.17, 0.11], least=least)
    assert now == pytest.approx(targets, rel=1e-4)
    got = [r.r for r in rows.orderBy("doc_id").select(rate.alias("r")).collect()]
    assert got[0] == 1 and min(got) + 1e-12 >= least and (100 * np.array(got[1:]) @ p).tolist() == pytest.approx(targets, rel=1e-4)


def test_targets_that_no_rates_meet_are_reported(spark):
    rows = spark.createDataFrame([(i, 100, [0.5, 0.5]) for i in range(9)], "doc_id long, n_tokens long, p array<double>")
    with pytest.warns(UserWarning, match="meet the targets"):
        _, now, targets = mixing.fit_rates(rows, [0.9, 0.1])
    best = 2 / sum(1 / (2 * t) for t in targets)  # the total at which both misses weigh least
    assert now == pytest.approx([best / 2] * 2, rel=1e-3) and targets == pytest.approx([4050, 450])


def membership_rows(spark, tokens, p):
    return spark.createDataFrame([(i, int(t), q.tolist()) for i, (t, q) in enumerate(zip(tokens, p))], "doc_id long, n_tokens long, p array<double>")


@pytest.mark.parametrize(("weights", "seed"), [([0.55, 0.17, 0.17, 0.11], 1), ([0.01, 0.9, 0.05, 0.04], 2)])
def test_projected_gradient_alone_meets_the_targets(spark, monkeypatch, weights, seed):
    dice = np.random.default_rng(seed)
    p, tokens = dice.dirichlet([0.3] * 4, 600), dice.lognormal(5, 2, 600).round()
    monkeypatch.setattr(mixing, "_solved", None)  # the dual is not asked for
    rate, now, targets = mixing.fit_rates(membership_rows(spark, tokens, p), weights)
    got = np.array([r.r for r in membership_rows(spark, tokens, p).orderBy("doc_id").select(rate.alias("r")).collect()])
    assert got.min() >= 0 and (got[tokens == 0] == 1).all()
    assert (tokens * got @ p).tolist() == pytest.approx(targets, rel=2e-5) and now == pytest.approx(targets, rel=1e-5) and mixing.meets(now, targets)


def test_a_step_is_the_projected_step_by_hand(spark):
    p, tokens = np.array([[1.0, 0.0], [0.0, 1.0], [0.5, 0.5], [0.2, 0.8]]), [100, 50, 10, 4]
    steps = [mixing.Step((-2.0, 0.5), (1.0, -0.1)), mixing.Step((0.5, 1.0), (1.0, -2.0)), mixing.Step((0.5, 1.0), (-1.0, 0.0))]
    rates = np.ones(4)
    for step in steps:
        held = (rates <= 0) & (p @ step.slope >= 0)
        rates = np.where(held, rates, np.maximum(0, rates + p @ step.move))
    got = membership_rows(spark, tokens, p).orderBy("doc_id").select(mixing._rate(steps, 0.0).alias("r")).collect()
    assert [r.r for r in got] == pytest.approx(rates.tolist()) and rates[0] == 0.5  # held by the second, moved by the third


def test_gradient_and_dual_agree_where_nothing_is_held(spark):
    dice = np.random.default_rng(9)
    p, tokens = np.eye(3)[dice.integers(0, 3, 300)] * 0.9 + 0.1 / 3, dice.integers(1, 200, 300)
    rows, weights = membership_rows(spark, tokens, p), [0.4, 0.35, 0.25]
    rate, _, targets = mixing.fit_rates(rows, weights)
    move, _ = mixing._solved(rows, np.array(targets) / sum(targets), 0.0, sum(targets), 1e-6)
    both = rows.select(rate.alias("a"), mixing._moved(move, 0.0)[1].alias("b")).collect()
    assert [r.a for r in both] == pytest.approx([r.b for r in both], rel=1e-4)


def test_memberships_are_those_computed_by_hand(spark):
    docs = spark.createDataFrame([(1, "red RED blue", "a"), (2, "blue sky sky", "b"), (3, "red sky", None), (4, None, "a")], "doc_id long, text string, lang string")
    bucket = {r.w: r.b for r in spark.createDataFrame([("red",), ("blue",), ("sky",)], "w string").select("w", mixing._bucket(F.col("w")).alias("b")).collect()}
    assert len(set(bucket.values())) == 3
    counts = {"a": {"red": 2, "blue": 1, "sky": 0}, "b": {"red": 0, "blue": 1, "sky": 2}}

    def posterior(words):
        likely = [np.prod([(counts[d][w] + 1) / (3 + mixing.BUCKETS) for w in words]) for d in ("a", "b")]
        return [x / sum(likely) for x in likely]

    got = {r.doc_id: (r.n_tokens, r.p) for r in mixing.memberships(docs, ["a", "b"]).collect()}
    for key, words in {1: ["red", "red", "blue"], 2: ["blue", "sky", "sky"], 3: ["red", "sky"], 4: []}.items():
        assert got[key][0] == len(words) and got[key][1] == pytest.approx(posterior(words))


def test_rates_say_whether_the_targets_are_met(spark):
    docs = spark.createDataFrame([(1, "red red blue", "a"), (2, "sky sea sea", "b")], "doc_id long, text string, lang string")
    assert {r.met for r in mixing.mixing_rates(docs, {"a": 0.5, "b": 0.5}).collect()} == {True}
    same = spark.createDataFrame([(1, "red", "a"), (2, "red", "b")], "doc_id long, text string, lang string")
    with pytest.warns(UserWarning, match="meet the targets"):
        assert {r.met for r in mixing.mixing_rates(same, {"a": 0.9, "b": 0.1}).collect()} == {False}


# --- columns of any name ------------------------------------------------------------------


def test_stages_carry_columns_of_any_name(spark):
    rows = spark.createDataFrame([(1, "x y", "a", 1, 2, 3), (2, "X y", "a", 4, 5, 6), (3, "z", "b", 7, 8, 9), (3, "z", "b", 7, 8, 9)],
                                 "doc_id long, text string, lang string, `a.b` int, _key int, _label int")
    left = exact_dedup.dedup(rows)
    assert left.columns == rows.columns
    assert sorted((r.doc_id, r["a.b"]) for r in left.collect()) == [(2, 4), (3, 7)]
    mixed = mixing.mix(rows, {"a": 0.5, "b": 0.5}, least=1.0)
    assert mixed.columns == rows.columns and {r["a.b"] for r in mixed.collect()} == {1, 4, 7}
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 0)], "doc_id long, toxic int, _key int")
    assert toxicity.without_toxic(rows, labels).columns == rows.columns


def test_bounds_of_the_toxicity_sample_are_parameters(trained):
    docs, known, _ = trained
    small = toxicity.fit(docs, known, toxic_docs=60, ordinary_docs=90, toxic_windows=50, ordinary_windows=80)
    assert len(small.pairs) == toxicity.PAIRS and small.pairs != trained[2].pairs


def test_gains_and_features_are_those_computed_by_hand():
    pair = toxicity.Pair(b"you awful stupid people " * 8, b"a quiet walk in the park " * 8)
    some = toxicity.windows("You awful stupid people " * 6 + "a quiet walk in the park")
    expected = []
    for w in some:
        sizes = [len(toxicity._compressor(content).compress(w)) for content in (pair.ordinary, pair.toxic)]
        expected.append(sizes[0] - sizes[1])
    g = toxicity.gains(pair.compressors(), some)
    assert g.tolist() == expected and len(some) == 2 and g[0] > 0 > g[1]
    assert toxicity.features(g, 1.0) == pytest.approx([sum(expected) / 2**0.5, 1 / 2**0.5, 0.5, min(max(expected), 20) - 1])


def test_calibration_is_where_the_penalised_likelihood_is_flat():
    dice = np.random.default_rng(5)
    rows = dice.normal(0, 1, (300, 2))
    labels = (rows @ [2.0, -1.0] + dice.normal(0, 1, 300) > 0.3).astype(float)
    detector = toxicity.calibrate((), rows, labels)
    p = detector.score(rows)
    x = np.column_stack([np.ones(300), rows])
    assert np.abs(x.T @ (labels - p) - 1e-2 * np.array(detector.weights)).max() < 1e-4


def test_texts_without_spaces_take_linear_time():
    transducer = sentencepiece_fst.Transducer(sentencepiece_fst.model_bytes(public_tokenizers.path("piece_bpe_32k.model")))
    text = "".join(map(chr, np.random.default_rng(2).integers(0x4E00, 0x9FA5, 300_000)))
    start = time.process_time()
    ids = transducer.encode(text)
    assert time.process_time() - start < 5 and transducer.decode(ids) == text


# --- helpers ------------------------------------------------------------------------------


@pytest.mark.parametrize("nodes", [1, 30, 400])
def test_components_of_random_links(spark, nodes):
    dice = np.random.default_rng(nodes)
    links = [tuple(map(int, x)) for x in dice.integers(0, nodes, (nodes, 2))] + [(0, i) for i in range(0, nodes, 7)] + [(i, i + 1) for i in range(nodes, nodes + 60)]
    up = {x: x for pair in links for x in pair}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    expected = {x: top(x) for x in up if any(x in pair and pair[0] != pair[1] for pair in links)}
    rows = spark.createDataFrame([*links, (None, 5), (3, None)], "a long, b long")
    got = components(rows).collect()
    assert {r.node: r.label for r in got} == expected and len(got) == len(expected)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packing_keeps_numbers():
    dice = np.random.default_rng(0)
    for kind in (np.uint16, np.uint32, np.uint64, np.int64, np.float64, np.complex128):
        for n in (0, 1, 1000):
            numbers = dice.integers(0, 2**16, n).astype(kind)
            assert unpack(pack(numbers)).tolist() == numbers.tolist()
    keys = np.unique(dice.integers(0, 2**64, 5000, dtype=np.uint64))
    assert unpack_sorted(pack_sorted(keys)).tolist() == keys.tolist()
    cuts = bucket_cuts(keys, 7)
    assert [int(k) * 7 >> 64 for k in keys] == np.repeat(range(7), np.diff(cuts)).tolist()


# --- queries and the pipeline -------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_query_matches_its_sql(spark, name):
    got, want = compared(spark, SF, registered.QUERIES[name], registered.ORACLES[name])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registered.QUERIES) - set(registered.ORACLES) - {"pipeline"}))
def test_query_returns_a_row_for_each_row(spark, name):
    # op13's contract has a row for each vector and component up to 4
    table, each = {"op9_style_tree": ("pages", 1), "op13_whitening": ("embeddings", 4)}.get(name, ("documents", 1))
    assert registered.QUERIES[name](spark, SF).count() == each * spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_stages_of_the_pipeline(spark, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "sentencepiece"]
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        kept[name] = collections.Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert docs.columns == documents.columns or name == "sentencepiece"
    text = {r.doc_id: r.text for r in documents.collect()}
    fold = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    last = {fold(text[k]): k for k in sorted(kept["toxicity"])}
    assert set(kept["exact_dedup"]) == set(last.values())
    classes = registered.jaccard_join.jaccard_components(documents.where(F.col("doc_id").isin(*kept["exact_dedup"]))).collect()
    assert set(kept["jaccard_join"]) == {r.doc_id for r in classes if r.doc_id == r.component_id}
    assert set(kept["mixing"]) == set(kept["jaccard_join"]) and sum(kept["mixing"].values()) > len(kept["mixing"])
    assert kept["sentencepiece"] == kept["mixing"]
    assert all(r.decoded == text[r.doc_id] for r in docs.collect())
    assert corpus_pipeline.run(spark, SF).count() == sum(kept["mixing"].values())


@pytest.mark.parametrize("inside, after, kept, gone", [
    ("", '<section id="comments"><h2>Comments</h2><article class="comment"><p>Reader {0} says this {0}</p></article></section>', "", "Reader"),
    ("", '<ol class="commentlist"><li class="comment" id="comment-{0}"><p>Reader {0} says</p></li><li>Reader again {0}</li></ol>', "", "Reader"),
    ('<div class="comments-area"><div>Reader {0} within</div></div>', "", "", "Reader"),
    ('<p class="ad-hoc">An ad hoc remark of page {0} on {0}</p>', "", "An ad hoc remark of page {0} on {0}", "Reader"),
    ('<section class="related-work"><p>Related work of page {0}</p></section>', "", "Related work of page {0}", "Reader"),
    ('<pre><span class="comment"># code {0}</span></pre>', "", "# code {0}", "Reader"),
    ('<div class="ad">Buy this now</div>', '<div class="site-footer">All rights</div>', "", "Buy this"),
])
def test_comments_go_and_articles_keep_what_only_sounds_like_a_label(spark, inside, after, kept, gone):
    page = '<html><body class="comments-open"><nav><a>Home</a></nav><article><h1>Title {0}</h1><p>Own text of page {0}, number {0}.</p>' + inside + "</article>" + after + "</body></html>"
    rows = [(n, f"http://a.example/{n}", page.format(f"n{n * 7919}")) for n in range(40)]
    found = {r.page_id: r.text for r in style_tree.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n, text in found.items():
        name = f"n{n * 7919}"
        assert f"Own text of page {name}" in text and kept.format(name) in text and gone not in text, text
