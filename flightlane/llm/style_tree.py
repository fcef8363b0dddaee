"""HTML extraction by site style trees: what a site's pages share is told from what each has of its own."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.session import stored

#: Branches below this importance are removed.
THRESHOLD = 0.35
#: What the importance of menus, adverts and the like is multiplied by at least, and what that of an article is at least.
LABELLED_SHARE, ARTICLE_LEAST = 0.3, 0.5
#: How fast the layout of a branch counts for more than its contents, by different layouts.
GAMMA = 0.9
#: The tree of all sites counts for as much as that of a site with so many pages.
PRIOR_PAGES = 5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg title textarea select object canvas".split())
#: Raw elements that only their own end tag ends.
SCRIPTS = frozenset({"script", "style"})
BLOCKS = frozenset(("html body p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd div section article main blockquote pre table thead tbody "
                    "tfoot tr td th caption figure figcaption header footer nav aside form fieldset address center details "
                    "summary menu dialog hgroup").split())
#: A start of the first closes an open one of the second, up to one of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
MAIN = frozenset({"article", "main"})
LABELLED_TAGS = frozenset("nav footer aside form menu dialog button".split())
#: An article in one of these is a card or a teaser; a form may be around a whole page.
ASIDE = LABELLED_TAGS - {"form"}
LABELLED_WORDS = frozenset((
    "ad ads advert advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice popup modal "
    "newsletter subscribe signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget footer header "
    "masthead share sharing social related recommended pagination pager toolbar search "
    "complementary contentinfo").split())
#: Words that a name may have beside those and still be such a name: "ad-box" is one, "ad-hoc" is none.
PLAIN_WORDS = frozenset((
    "area bar block bottom box button buttons container content desktop global inner item items left link links list main mobile module "
    "outer page panel placeholder post posts primary right row secondary section site slot small sticky top unit wrap wrapper").split())
#: Blocks of these names hold what readers wrote. Their text differs from page to page like an article's, so no
#: importance can tell it from one; it is left out before the tree is made.
COMMENT_WORDS = frozenset("comment comments commentlist commentarea disqus respond".split())
COMMENT_TAGS = frozenset("div section article aside ol ul li".split())
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


class Node:
    """An open element: its path of tags and names, whether it is labelled as no content, the path of the article it is
    in, whether it is in an element of ASIDE, the paths of the labelled elements that it is or is in, and whether it is
    in readers' comments."""

    __slots__ = ("tag", "path", "labelled", "article", "aside", "labels", "comment", "children")

    def __init__(self, tag: str, path: str, labelled: bool, article: str | None, aside: bool, labels: tuple[str, ...], comment: bool):
        self.tag, self.path, self.labelled, self.article, self.aside, self.labels, self.comment = tag, path, labelled, article, aside, labels, comment
        self.children: list[str] = []

    def below(self, tag: str, name: str, labelled: bool, comment: bool) -> Node:
        """An element in this one. Labels pass down, but not into the article or main part of a page."""
        path = f"{self.path}/{name}"
        labelled = labelled or tag in LABELLED_TAGS or (tag == "header" and self.article is None)
        starts = tag in MAIN and self.article is None and not self.aside
        return Node(tag, path, labelled or (self.labelled and not starts), path if starts else self.article,
                    self.aside or tag in ASIDE, (*self.labels, path) if labelled else self.labels, self.comment or comment)


def _named(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """The element's name in a path (numbers in it do not count), whether a name of it labels it, and whether
    one says that it holds comments. A name does so with a word of the list and none that says something else."""
    if not attributes or "=" not in attributes:
        return tag, False, False
    words, labelled, comment = [], False, False
    for key, *values in _NAMES.findall(attributes):
        for name in next((v for v in values if v), "").split():
            own = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
            words += own
            if any(w in LABELLED_WORDS for w in own) and all(w in LABELLED_WORDS or w in PLAIN_WORDS or w in COMMENT_WORDS for w in own):
                labelled = labelled or (tag not in MAIN and tag not in ("html", "head", "body"))
            if any(w in COMMENT_WORDS for w in own) and all(w in COMMENT_WORDS or w in PLAIN_WORDS for w in own):
                comment = comment or tag in COMMENT_TAGS
    return (f"{tag}.{'.'.join(words)}" if words else tag), labelled, comment


def _script_end(page: str, at: int, tag: str) -> int:
    end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
    return end.end() if end else len(page)


def _raw_end(page: str, at: int, tag: str, around: set[str]) -> int:
    """Where a raw element that starts at ``at`` ends, ``around`` being the tags of the elements it is in.

    One without an end tag of its own ends at its parent's end or at a block in it, whichever is first;
    a script or style without one holds the rest of the page.
    """
    if tag in SCRIPTS:
        return _script_end(page, at, tag)
    closed = re.compile(rf"</{tag}\b", re.I).search(page, at)
    inner: list[str] = []
    block = None
    while match := _TOKEN.search(page, at):
        name = (match[2] or match[5] or "").lower()
        at = match.end()
        if match[1] or match[4]:
            if name in inner:
                while inner.pop() != name:
                    pass
            elif name == tag:
                return at
            elif name in around or name == "head":
                return match.start() if block is None else block
        elif name == "body":
            return match.start() if block is None else block
        elif name in SCRIPTS:
            at = _script_end(page, at, name)
        elif name and name not in VOID and not (match[3] or match[6] or "").endswith("/"):
            if block is None and name in BLOCKS:
                block = match.start()
                if not closed:
                    return block
            inner.append(name)
    return len(page) if block is None else block


def parse(page: str | None) -> tuple[list[tuple[Node, str]], list[tuple[str, str]]]:
    """The blocks of text of a page in page order with their elements, and the layout of every element.

    Open ends, missing end tags and stray ones are taken as browsers do in the simple cases: a block
    closes an open paragraph, an end tag closes what is open inside. Readers' comments are left out.
    """
    page = (page or "").removeprefix("\ufeff")  # a byte order mark is no text
    root = Node("", "", False, None, False, (), False)
    stack, blocks, shapes, parts = [root], [], [], []

    def flush() -> None:
        if stack[-1].comment:
            parts.clear()
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                blocks.append((stack[-1], text))
            parts.clear()

    def close(to: int) -> None:
        flush()
        while len(stack) > to:
            node = stack.pop()
            if node.children and not node.comment:
                shapes.append((node.path, " ".join(node.children)))

    at = 0
    while match := _TOKEN.search(page, at):
        if match.start() > at:
            parts.append(page[at : match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        if match[1] or match[4]:
            if tag in BLOCKS or any(n.tag == tag for n in stack[1:]):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close(i)
                        break
            continue
        attributes = match[3] or match[6] or ""
        if tag in RAW:
            if not attributes.endswith("/"):
                at = _raw_end(page, at, tag, {n.tag for n in stack})
            parts.append(" ")
            continue
        if tag in VOID:
            parts.append("\n" if tag in ("br", "hr") else "")
            continue
        name, labelled, comment = _named(tag, attributes)
        if tag not in BLOCKS and not labelled and tag not in LABELLED_TAGS:
            continue  # inline elements are text
        if tag in BLOCKS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in ("td", "th", "table", "body", "article", "div", "section"):
                    break
            if tag in CLOSES:
                ends, limits = CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in limits:
                        break
                    if stack[i].tag in ends:
                        close(i)
                        if tag != "tr":
                            break
        flush()
        above = stack[-1]
        if not above.children or above.children[-1] != name:
            above.children.append(name)
        stack.append(above.below(tag, name, labelled, comment))
    if at < len(page):
        parts.append(re.sub(r"<[a-zA-Z/!][^>]*\Z", "", page[at:]))
    close(1)
    return blocks, shapes


def site(url: str) -> Column:
    """The host of an address in lower case; empty without one."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many pages of a batch have each element of each site, and each text and layout of it; for
    labelled elements also the characters in them and on the pages that have them."""
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.int64())
    for batch in batches:
        counts: Counter = Counter()
        flags: dict[str, tuple[bool, str | None]] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            blocks, shapes = parse(page.as_py())
            found = {("page", "", 0)}
            inside: Counter = Counter()
            for node, text in blocks:
                flags[node.path] = (node.labelled, node.article)
                masked = text.replace(host, "\0") if host else text  # a site's name is the same word on all sites
                found.add(("element", node.path, 0))
                found.add(("text", node.path, xxhash.xxh3_64_intdigest(masked) >> 1))
                for path in node.labels:
                    inside[path] += len(text)
            found.update(("layout", path, xxhash.xxh3_64_intdigest(shape) >> 1) for path, shape in shapes)
            counts.update((host, *f) for f in found)
            chars = sum(len(text) for _, text in blocks)
            for path, n in inside.items():
                counts[host, "inside", path, 0] += n
                counts[host, "around", path, 0] += chars
        columns = zip(*((h, kind, path, feature, *flags.get(path, (False, None)), n) for (h, kind, path, feature), n in counts.items()))
        arrays = [pa.array(list(c), t) for c, t in zip(columns, kinds)]
        if arrays:
            yield pa.RecordBatch.from_arrays(arrays, names=["site", "kind", "path", "feature", "labelled", "article", "n"])


def style_trees(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """site, path, importance: the branches of the merged style tree of every site, and of that of all sites (site '*').

    A text that k of the m pages with its element have says log_m(k) of nothing new, so an element's
    content is as important as its different texts are rare on average; an element's layout is as
    important as its entropy over the pages. A branch combines its layout with the contents below it,
    the layout counting for more the more layouts there are, and is as important as the most important
    branch in it, so one goes only where all in it may go.

    An element labelled as a menu or the like has that multiplied by the share that it holds of the
    text of its pages, LABELLED_SHARE at least: an advert counts for little, a wrapper around
    a page's own text for all of it. A branch around an article is worth ARTICLE_LEAST at least, one in
    it only where no part of the article tells the pages apart.

    Few pages say little: the value of a site with n pages is n parts its own and PRIOR_PAGES parts
    that of '*', whatever n is. A branch that no other site has is worth there what it is on its site.

    Only counts of elements, texts and layouts move, added up in each task first, so one site may
    have any share of the pages.
    """
    schema = "site string, kind string, path string, feature long, labelled boolean, article string, n long"
    counted = pages.select(site(url).alias("site"), F.col(page).cast("string")).mapInArrow(_features, schema)
    added = [F.sum("n").alias("n"), F.max("labelled").alias("labelled"), F.max("article").alias("article")]
    by_site = stored(counted.groupBy("site", "kind", "path", "feature").agg(*added), "style-counts")
    rows = by_site.unionByName(by_site.groupBy("kind", "path", "feature").agg(*added).withColumn("site", F.lit("*")))
    key = ["site", "path"]
    elements = rows.where("kind = 'element'").select(*key, F.col("n").alias("m"), "labelled", "article")
    texts = rows.where("kind = 'text'").groupBy(key).agg(F.count("*").alias("texts"), F.sum(F.ln("n")).alias("logs"))
    layouts = rows.where("kind = 'layout'").groupBy(key).agg(
        F.count("*").alias("layouts"), F.sum("n").alias("all"), F.sum(F.col("n") * F.ln("n")).alias("logs")).select(
        *key, "layouts", F.when(F.col("all") > 1, 1 - F.col("logs") / (F.col("all") * F.ln("all"))).otherwise(1.0).alias("layout"))
    held = [F.sum(F.when(F.col("kind") == kind, F.col("n"))) for kind in ("inside", "around")]
    shares = rows.where("kind in ('inside', 'around')").groupBy(key).agg((held[0] / held[1]).alias("share"))
    content = F.when(F.col("m") > 1, 1 - F.col("logs") / (F.col("texts") * F.ln("m"))).otherwise(1.0)
    names = F.split("path", "/")
    # text outside every element is a branch of its own, above nothing
    above = F.when(F.col("path") == "", F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(names))), lambda i: F.array_join(F.slice(names, 1, i), "/")))
    mine = F.when(~F.col("labelled"), F.col("article"))
    depth = F.length("path") - F.length("article")
    branches = elements.join(texts, key).select("site", "labelled", "article", content.alias("content"), F.explode(above).alias("path")).groupBy(key).agg(
        F.avg("content").alias("content"), F.count(F.when(depth <= 0, mine)).alias("around"), F.max(F.when(depth > 0, mine)).alias("article"))
    weight = F.pow(F.lit(GAMMA), F.coalesce("layouts", F.lit(0)))
    plain = (1 - weight) * F.coalesce("layout", F.lit(0.0)) + weight * F.col("content")
    composite = branches.join(layouts, key, "left").join(shares, key, "left").select(*key, "around", "article", "share", plain.alias("plain"))
    best = composite.select("site", "plain", F.explode(above).alias("path")).groupBy(key).agg(F.max("plain").alias("best"))
    whole = best.select("site", F.col("path").alias("article"), F.col("best").alias("whole"))
    floor = F.when((F.col("around") > 0) | (F.col("whole") < THRESHOLD), ARTICLE_LEAST).otherwise(0.0)
    importance = F.greatest(F.col("best") * F.greatest(F.coalesce("share", F.lit(1.0)), F.lit(LABELLED_SHARE)), floor)
    judged = stored(composite.join(best, key).join(whole, ["site", "article"], "left").select(*key, importance.alias("importance")), "branches")
    counts = by_site.where("kind = 'page'").select("site", F.col("n").alias("pages"))
    common = judged.where("site = '*'").select("path", F.col("importance").alias("common"))
    blended = (F.col("pages") * F.col("importance") + PRIOR_PAGES * F.col("common")) / (F.col("pages") + PRIOR_PAGES)
    return judged.join(counts, "site", "left").join(common, "path").select(*key, F.coalesce(blended, "importance").alias("importance"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, low in zip(batch.column(2), batch.column(3).to_pylist()):
            low = tuple(low or ())
            exact, under = frozenset(low), tuple(f"{p}/" for p in low if p)
            texts.append("\n\n".join(text for node, text in parse(page.as_py())[0] if node.path not in exact and not node.path.startswith(under)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    The blocks of a page outside branches of low importance in its site's style tree, in page order,
    joined by two line breaks; in a block white space is one space and character references are
    decoded. Null and empty pages have no text. Pages without an address are one site; null keys,
    repeated rows and copies are rows like any other; other columns are ignored; an empty table gives
    an empty result.
    """
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(page).cast("string").alias("html"), site(url).alias("site"))
    # paths of elements, in which numbers do not count, so a site has few whatever its pages
    low = stored(style_trees(rows, "url", "html").where(F.col("importance") < threshold).groupBy("site").agg(F.collect_set("path").alias("low")), "low-branches")
    return rows.join(low, "site", "left").select("page_id", "url", "html", "low").mapInArrow(
        _texts, "page_id long, url string, text string, n_chars long")
