"""N-gram Jaccard join: shingle sets in a prefix tree, under one global order of shingles."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlane.llm.common import WordHashes, fold_words, forget, give_back, without_keys
from flightlane.llm.components import components
from flightlane.llm.exchange import SENT, SENT_ARROW, answers_of, block_table, bucket_count, exchange, sent_rows, to_batch
from flightlane.llm.packing import mixed, pack, pack_sorted, unpack, unpack_sorted
from flightlane.session import stored

SHINGLE_WORDS = 4
#: Linked when 100 * intersection >= THRESHOLD * union.
THRESHOLD = 85
#: A block ends behind the text with which it reaches so many characters.
BLOCK_CHARS = 3_000_000
#: Shingles in one tree at most, on average; larger groups are joined piece by piece.
TREE_SHINGLES = 1_000_000

_BLOCKS = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("which", pa.binary()), ("lengths", pa.binary()),
                     ("places", pa.binary()), ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("n", pa.int64()), ("print_a", pa.int64()), ("print_b", pa.int64())])))])
_BLOCKS_DDL = ("block long, keys binary, counts binary, which binary, lengths binary, places binary, "
               "docs array<struct<doc_id: long, n: long, print_a: long, print_b: long>>")
_CANDIDATES = "row long, n long, posted array<long>"
_DEALT = "label long, piece long, pieces long, row long, n long, shingles binary, counts binary"


def shingle_set(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of a text as ascending 64-bit hashes; shorter texts are one shingle."""
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(h) == 0:
        return h
    span = min(size, len(h))
    out = np.full(len(h) - span + 1, span, np.uint64)
    for i in range(span):
        out = mixed(out, h[i : len(h) - span + 1 + i])
    return np.unique(out)


def prefix_length(n: int, threshold: int) -> int:
    """So many of its first shingles cannot all be missing in a set that links with a set of ``n``."""
    return n + (-threshold * n) // 100 + 1


def needed(a: int, b: int, threshold: int) -> int:
    """The least intersection with which sets of these sizes link."""
    return -((-threshold * (a + b)) // (100 + threshold))


def _blocks(batches: Iterator[pa.RecordBatch], size: int, chars: int) -> Iterator[pa.RecordBatch]:
    """A row per block: its different shingles, in how many of its different sets each is, the sets as
    places among the shingles, which document has each set, and all documents."""
    forget()
    base, number, hashes = TaskContext.get().partitionId() << 16, 0, WordHashes()
    names: list = []
    sets: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal number, names, sets, held
        prints = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        first: dict[int, int] = {}
        for i, (p, s) in enumerate(zip(prints, sets)):
            if len(s):
                first.setdefault(p, i)
        own = [sets[i] for i in first.values()]  # a text that is repeated in a block counts once
        lengths = np.array([len(s) for s in own], np.uint32)
        keys, place, n = np.unique(np.concatenate(own or [np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
        halves = np.array([[p >> 64, p & (2**64 - 1)] for p in prints], np.uint64).view(np.int64).tolist()
        docs = [{"doc_id": name, "n": len(s), "print_a": a, "print_b": b} for name, s, (a, b) in zip(names, sets, halves)]
        row = (base + number, pack_sorted(keys), pack(n.astype(np.uint32)), pack(np.array(list(first.values()), np.uint32)),
               pack(lengths), pack(_steps(place, lengths)), docs)
        number, names, sets, held = number + 1, [], [], 0
        return to_batch([row], _BLOCKS)

    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            names.append(name)
            sets.append(shingle_set(fold_words(text), size, hashes))
            held += len(text or "") + 16
            if held >= chars:
                yield flush()
    if names:
        yield flush()
    give_back()


def _send_counts(buckets: int, bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield to_batch(list(sent_rows(row["block"], unpack_sorted(row["keys"]), unpack(row["counts"]), buckets, bits)), SENT_ARROW)

    return send


def _steps(place: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ascending places per set as differences; each set starts anew."""
    place = place.astype(np.uint32)
    steps = np.diff(place, prepend=np.uint32(0))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    steps[starts] = place[starts] if len(place) else 0
    return steps


def _document_counts(distinct, place, blocks, numbers):
    """In how many sets each key is, at least: keys that begin alike are counted together."""
    return np.bincount(place, numbers, len(distinct)).astype(np.uint32)[place], None


class _Sets:
    """A block's sets, as a task reads them back, with the counts of their shingles over all documents."""

    def __init__(self, row: dict, answers: list[dict]):
        self.block, self.keys = row["block"], unpack_sorted(row["keys"])
        self.counts = answers_of([(r["bucket"], r["answer"]) for r in answers])
        self.which, lengths = unpack(row["which"]).tolist(), unpack(row["lengths"]).astype(np.int64)
        self._steps, self._ends = unpack(row["places"]), np.cumsum(lengths)
        self._starts = self._ends - lengths

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        """The number of each set's row, and its shingles as places among the keys."""
        for i, start, end in zip(self.which, self._starts, self._ends):
            yield (self.block << 24) + i, np.cumsum(self._steps[start:end])


def _candidates(threshold: int):
    """Per block: the sets that could link with another one, with the shingles to find it by."""

    def of_block(left: pa.Table, right: pa.Table) -> pa.Table:
        sets = _Sets(left.to_pylist()[0], right.to_pylist())
        rows, sizes, posts = [], [], []
        for row, here in sets:
            df, length = sets.counts[here], prefix_length(len(here), threshold)
            if np.count_nonzero(df == 1) >= length:
                continue  # the prefix holds nothing that another set has
            prefix = np.argsort(df, kind="stable")[:length]  # rarest first, ties by the key
            rows.append(row)
            sizes.append(len(here))
            posts.append(sets.keys[here[prefix[df[prefix] > 1]]].view(np.int64))
        give_back()
        return pa.table({"row": pa.array(rows, pa.int64()), "n": pa.array(sizes, pa.int64()), "posted": pa.array(posts, pa.list_(pa.int64()))})

    return of_block


def _deal(left: pa.Table, right: pa.Table) -> pa.Table:
    """Per block: its sets that are members of a group, each once."""
    told = right.to_pylist()
    members = {r["row"]: r for r in told if r["row"] is not None}
    out: dict[str, list] = {name.split()[0]: [] for name in _DEALT.split(", ")}
    sets = _Sets(left.to_pylist()[0], [r for r in told if r["answer"] is not None]) if members else ()
    for row, here in sets:
        if row in members:
            shingles, counts = pack_sorted(sets.keys[here]), pack(sets.counts[here])
            m = members[row]
            for name, value in zip(out, (m["label"], m["piece"], m["pieces"], row, len(here), shingles, counts)):
                out[name].append(value)
    give_back()
    return pa.table({name: pa.array(values, pa.binary() if name in ("shingles", "counts") else pa.int64()) for name, values in out.items()})


class Tree:
    """A prefix tree of distinct sets whose edges hold runs of shingles, most frequent first.

    A node knows the size of the smallest set below it and the longest way down behind its run,
    which bound the overlap a set can still reach there, and a member whose class all sets at and
    below it are in, where that is so.
    """

    __slots__ = ("run", "below", "member", "least", "depth", "one")

    def __init__(self, run: tuple = (), member: int | None = None, least: int = 0, depth: int = 0, one: int | None = None):
        self.run, self.member, self.least, self.depth, self.one = run, member, least, depth, one
        self.below: dict[int, Tree] = {}


class Classes:
    """Which sets are known to be connected."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def of(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.of(i), self.of(j)
        self.up[max(i, j)] = min(i, j)


def _insert(root: Tree, ranks: tuple, name: int, classes: Classes) -> None:
    node, rest, n, own = root, ranks, len(ranks), classes.of(name)
    while rest:
        child = node.below.get(rest[0])
        if child is None:
            node.below[rest[0]] = Tree(rest, name, n, 0, name)
            return
        run, same = child.run, 0
        for x, y in zip(run, rest):
            if x != y:
                break
            same += 1
        if same < len(run):
            upper = Tree(run[:same], None, child.least, child.depth + len(run) - same, child.one)
            child.run = run[same:]
            upper.below[child.run[0]] = child
            node.below[rest[0]] = child = upper
        rest = rest[same:]
        child.least, child.depth = min(child.least, n), max(child.depth, len(rest))
        if child.one is not None and classes.of(child.one) != own:
            child.one = None
        node = child
    node.member = name


def _all_in(node: Tree, own: int, classes: Classes) -> bool:
    """Whether all sets at and below the node are in the class ``own``."""
    if node.one is not None:
        return classes.of(node.one) == own
    stack, member = [node], None
    while stack:
        at = stack.pop()
        for one in (at.one, at.member):
            if one is not None:
                member = one
                if classes.of(one) != own:
                    return False
        if at.one is None:
            stack += at.below.values()
    node.one = member
    return True


def _probe(root: Tree, ranks: tuple, name: int, classes: Classes, threshold: int) -> Iterator[int]:
    """Members that the set links with, at least one of each class that it links with."""
    n, held = len(ranks), frozenset(ranks)
    smallest, largest = -(-threshold * n // 100), 100 * n // threshold
    stack = [(child, 0, 0) for child in root.below.values()]
    while stack:
        node, overlap, above = stack.pop()
        if node.least > largest or _all_in(node, classes.of(name), classes):
            continue
        least = needed(n, max(node.least, smallest), threshold)
        behind = n - bisect_right(ranks, node.run[-1])  # what the set has left behind the run
        if overlap + min(len(node.run), n - behind) + min(node.depth, behind) < least:
            continue
        overlap += len(held.intersection(node.run))
        above += len(node.run)
        if overlap + min(node.depth, behind) < least:
            continue
        # the way down to a member is its whole set, so the overlap is complete
        if node.member is not None and 100 * overlap >= threshold * (n + above - overlap) and classes.of(node.member) != classes.of(name):
            classes.join(node.member, name)
            yield node.member
        # shared ways first: one link may settle all the others
        stack += sorted(((child, overlap, above) for child in node.below.values()), key=lambda x: x[0].run[0] in held)


def tree_links(sets: list[np.ndarray], counts: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """Links between distinct sets that connect all sets connected by any links: a spanning forest."""
    keys, first, place = np.unique(np.concatenate(sets), return_index=True, return_inverse=True)
    order = np.lexsort((keys, -np.concatenate(counts).astype(np.int64)[first]))  # most frequent first, ties by key
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    ranks, at = rank[place], 0
    root, classes, links = Tree(), Classes(len(sets)), []
    for name, s in enumerate(sets):
        own = tuple(np.sort(ranks[at : at + len(s)]).tolist())
        at += len(s)
        links += [(member, name) for member in _probe(root, own, name, classes, threshold)]
        _insert(root, own, name, classes)
    return links


def _join_slot(threshold: int):
    def of_slot(group: pa.Table) -> pa.Table:
        forget()
        places: dict[tuple, list[tuple]] = {}
        for at, (label, i, j, n, row) in enumerate(zip(*(group[c].to_pylist() for c in ("label", "i", "j", "n", "row")))):
            places.setdefault((label, i, j), []).append((n, row, at))
        shingles, counts, a, b = group["shingles"], group["counts"], [], []
        for members in places.values():  # the sets of one group at a time; all others stay packed
            members.sort()
            found = tree_links([unpack_sorted(shingles[at].as_py()) for _, _, at in members], [unpack(counts[at].as_py()) for _, _, at in members], threshold)
            a += [members[i][1] for i, _ in found]
            b += [members[j][1] for _, j in found]
        give_back()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return of_slot


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS,
                       threshold: int = THRESHOLD, block_chars: int = BLOCK_CHARS, tree_shingles: int = TREE_SHINGLES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the least key that links reach).

    Two texts link when their sets of ``size``-word shingles have a Jaccard similarity of ``threshold``
    percent or more; shorter texts are one shingle; texts without words link with nothing. The key is
    an integer; null keys are never a component_id unless no other key is in the component; rows that
    repeat a key or a text are rows like any other. Other columns are ignored; an empty table gives an
    empty result.

    1. Blocks of documents count in how many sets each shingle is (see ``exchange``).
    2. The global order is rarest first. Of any two sets that link, the prefixes share a shingle, so
       sets whose prefix holds only shingles of their own are done.
    3. Sets that share a shingle of their prefixes, directly or over others, form a group; each group
       is joined with a prefix tree. A group of more than ``tree_shingles`` is cut into pieces by
       hash, and every two pieces meet by themselves, so what a task holds at a time does not grow with
       the group. The work does: each of its members is sent to every piece.

    Equal sets are one set throughout, and sets known to be connected are not compared again, so a
    group of copies costs no pairs. Shingles are told apart by 64-bit hashes, sets by 128 bits.
    """
    spark = docs.sparkSession
    buckets = bucket_count(spark)
    # the order needs no exact counts; with 20 bits more than rows, few keys begin alike
    bits = min(64, docs.count().bit_length() + 20)
    blocks = block_table(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        lambda batches: _blocks(batches, size, block_chars), _BLOCKS_DDL), "shingle-blocks")
    answers = stored(exchange(blocks.select("block", "keys", "counts").mapInArrow(_send_counts(buckets, bits), SENT), _document_counts), "shingle-counts")
    held = blocks.select("block", "keys", "which", "lengths", "places").groupBy("block")
    candidates = stored(held.cogroup(answers.groupBy("block")).applyInArrow(_candidates(threshold), _CANDIDATES), "set-candidates")
    rows = blocks.select("block", F.posexplode("docs").alias("i", "d")).select(
        (F.shiftleft("block", 24) + F.col("i")).alias("row"), "d.doc_id", "d.n", "d.print_a", "d.print_b")
    sets = stored(rows.where("n > 0").groupBy("print_a", "print_b").agg(F.min("row").alias("row"), F.min("doc_id").alias("doc_id")), "sets")

    posted = candidates.select("row", "posted").join(sets.select("row"), "row", "left_semi").select("row", F.explode("posted").alias("shingle"))
    shared = posted.groupBy("shingle").agg(F.min("row").alias("least"), F.count("*").alias("n")).where("n > 1").select("shingle", "least")
    groups = components(posted.join(shared, "shingle").select(F.col("row").alias("a"), F.col("least").alias("b")))
    members, slots = _members(candidates, groups, buckets, tree_shingles)
    told = answers.unionByName(members, allowMissingColumns=True)
    dealt = held.cogroup(told.groupBy("block")).applyInArrow(_deal, _DEALT)
    classes = components(_meetings(dealt, slots).groupBy("slot", "i", "j").applyInArrow(_join_slot(threshold), "a long, b long"))

    labelled = stored(sets.join(classes, sets["row"] == classes["node"], "left").select(
        "print_a", "print_b", F.coalesce("label", "row").alias("label"), "doc_id"), "set-classes")
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_print = labelled.join(least, "label").select("print_a", "print_b", "component_id")
    some = rows.where("n > 0").join(by_print, ["print_a", "print_b"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return some.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _members(candidates: DataFrame, groups: DataFrame, buckets: int, tree_shingles: int) -> tuple[DataFrame, int]:
    """block, row, label, piece, pieces of every member of a group (node, label), and in how many slots
    the groups of one piece are joined."""
    members = stored(groups.join(candidates.select("row", "n"), F.col("node") == F.col("row")).select("row", "n", "label"), "group-members")
    sizes = members.groupBy("label").agg(F.ceil(F.sum("n") / tree_shingles).alias("pieces"))
    total = members.agg(F.sum("n")).first()[0] or 0
    piece = F.pmod(F.xxhash64("row"), F.col("pieces"))
    return members.join(sizes, "label").select(F.shiftright("row", 24).alias("block"), "row", "label", piece.alias("piece"), "pieces"), \
        max(buckets, 2 * total // tree_shingles)


def _meetings(dealt: DataFrame, slots: int) -> DataFrame:
    """The members once for every place (slot, i, j) where they are joined with others.

    Groups of one piece share slots; any two pieces i and j of a larger group, whose label is then
    the slot, have a place of their own. Members are repeated as they are sent, not held.
    """
    meets = F.when(F.col("pieces") == 1, F.array(F.struct(F.lit(-1).cast("long").alias("i"), F.lit(-1).cast("long").alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1),
                    lambda x: F.struct(F.least("piece", x).alias("i"), F.greatest("piece", x).alias("j"))))
    slot = F.when(F.col("pieces") == 1, F.pmod(F.xxhash64("label"), F.lit(slots))).otherwise(F.col("label"))
    return dealt.withColumn("meet", F.explode(meets)).select(slot.alias("slot"), "meet.i", "meet.j", "label", "row", "n", "shingles", "counts")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key is the least of their component, with all their columns.

    Rows with a null key and rows that repeat the least key stay.
    """
    return without_keys(docs, key, jaccard_components(docs, key, text).where("doc_id <> component_id").select("doc_id"))
