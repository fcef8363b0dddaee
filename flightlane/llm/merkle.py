"""Merkle manifest of a dataset: nodes that carry the interval of leaf ranks they cover.

Every group of rows is a tree over its leaves in order, and the trees' roots are the leaves of one
more tree. A node of level k covers up to WIDTH ** k ranks, [lo, hi), from a multiple of that on. So the
node of the next level that contains an interval is found by an equality on the bucket its lower end
falls into, and what the parent's children cover besides the node's own interval are its siblings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.llm.common import small
from flightlane.llm.ranks import exact, ranked, same
from flightlane.session import stored

#: Children of a node at most.
WIDTH = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of the text's bytes."""
    return F.sha2(text, 256)


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: of each field ``-`` when it is null, else the count of its bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


@dataclass
class Tree:
    """Trees of all groups. ``leaves``: group, rank, n, digest and carried columns. ``levels``: from
    level 1 on one table each of group, n, lo, hi, digest and the children's intervals and digests."""

    group: list[str]
    leaves: DataFrame
    levels: list[DataFrame]

    def level(self, k: int) -> DataFrame:
        if k:
            return self.levels[k - 1]
        return self.leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1})

    def roots(self) -> DataFrame:
        """group, digest: the one node of each group that covers all its leaves."""
        found = [self.level(k).where(_is_root(k)).select(*self.group, "digest") for k in range(len(self.levels) + 1)]
        return _all(found)


@dataclass
class Manifest:
    """The trees of the groups and the tree over their roots."""

    trees: Tree
    top: Tree

    def root(self) -> DataFrame:
        """One row with the digest of the dataset, none for an empty one."""
        return self.top.roots().select("digest")

    def nodes(self) -> DataFrame:
        """The whole manifest: group, level, lo, hi, digest; the tree over the groups has the level -1 - its own."""
        of_groups = [self.trees.level(k).select(*self.trees.group, F.lit(k).alias("level"), "lo", "hi", "digest") for k in range(len(self.trees.levels) + 1)]
        none = [F.lit(None).cast(self.trees.leaves.schema[g].dataType).alias(g) for g in self.trees.group]
        above = [self.top.level(k).select(*none, F.lit(-1 - k).alias("level"), "lo", "hi", "digest") for k in range(len(self.top.levels) + 1)]
        return _all(of_groups + above)


def manifest(rows: DataFrame, key: str = "doc_id", group: str = "source", fields: list[str] = FIELDS,
             carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``rows``: a leaf per row, a tree per group, leaves in the order of their keys.

    Nulls: a null field is a field of its own kind, a null key or group comes first. Rows that share
    a key are ordered by their digests, so rows that repeat are leaves of their own and change
    nothing in each other's order. Texts of any length are hashed whole; an empty table has no node
    and no root. Of other columns only ``carry`` is kept, under the given names.

    The text is read once and never moved: what is dealt out are digests. A hot group is spread over
    tasks by ranges of keys, and a parent takes WIDTH children.
    """
    carry = carry or {}
    leaves = rows.select(exact(key).alias("_key"), exact(group).alias("_group"), leaf_digest([exact(f) for f in fields]).alias("digest"),
                         F.monotonically_increasing_id().alias("_row"), *[c.alias(n) for n, c in carry.items()])
    trees = _tree(stored(leaves, "leaves"), ["_group"], ["_key", "digest", "_row"])
    return Manifest(trees, _tree(trees.roots().withColumn("_all", F.lit(0)), ["_all"], ["_group"]))


def proofs(made: Manifest) -> DataFrame:
    """For every leaf: key, group, leaf (its digest), what was carried, the subroot of its group, the root, and
    ``path``: from the leaf to the root the digests to its left and to its right, one struct a level."""
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    start = made.root().select(F.lit(0).alias("_all"), F.col("digest").alias("root"), nothing.alias("path"))
    above = _paths(made.top, stored(start, "root"), ["_group", "root"]).withColumnRenamed("digest", "subroot")
    carried = [c for c in made.trees.leaves.columns if c not in ("rank", "n", "_row", "digest", "_group")]
    found = _paths(made.trees, stored(above, "subroots"), ["_group", *carried, "subroot", "root"])
    return found.withColumnsRenamed({"_key": "key", "_group": "group", "digest": "leaf"})


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to: its digest between its siblings', level by level."""
    return F.aggregate(path, leaf, lambda made, step: digest(F.concat(step["left"], made, step["right"])))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on the path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def verified(rows: DataFrame, leaf: str = "leaf", path: str = "path", root: str = "root") -> DataFrame:
    """``rows`` of proofs with ``folded_root``, recomputed from their leaf, and whether it is the root."""
    folded = rows.withColumn("folded_root", fold(exact(leaf), exact(path)))
    return folded.withColumn("verified", F.col("folded_root") == exact(root))


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _is_root(level: int) -> Column:
    """On the first level at which one node covers the group."""
    return (F.col("n") <= WIDTH ** level) & (F.col("n") > (WIDTH ** (level - 1) if level else 0))


def _bucket(level: int) -> Column:
    """The node of the next level in which a node of ``level`` lies."""
    return F.expr(f"lo div {WIDTH ** (level + 1)}")


def _tree(rows: DataFrame, group: list[str], order: list[str]) -> Tree:
    """Trees over ``rows`` with a digest; each level is written, as it is read on the way up and down."""
    leaves = stored(ranked(rows, group, order), "ranked-leaves")
    tree = Tree(group, leaves, [])
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while largest > WIDTH ** len(tree.levels):
        k = len(tree.levels)
        children = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))
        runs = tree.level(k).where(F.col("n") > WIDTH ** k).groupBy(*group, "n", _bucket(k).alias("_bucket")).agg(children.alias("children"))
        nodes = runs.select(*group, "n", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
                            digest(F.array_join("children.digest", "")).alias("digest"), "children")
        tree.levels.append(stored(nodes, "nodes"))
    return tree


def _paths(tree: Tree, start: DataFrame, keep: list[str]) -> DataFrame:
    """Leaves with their path. ``start`` has for every group the path of its root and columns that its leaves inherit."""
    group, inherited = tree.group, [c for c in start.columns if c not in (*tree.group, "path")]
    start, parents = small(start), None
    for k in range(len(tree.levels), -1, -1):
        nodes = tree.level(k)
        top = nodes.where(_is_root(k))
        found = top.join(start, same(top, start, group)).select(*[top[c] for c in nodes.columns], *[start[c] for c in inherited], start["path"])
        if parents is not None:
            found = found.unionByName(_under(nodes.where(F.col("n") > WIDTH ** k), parents, k, group, inherited))
        parents = stored(found, "paths") if k else found
    return parents.select(*keep, "digest", "path")


def _under(nodes: DataFrame, parents: DataFrame, k: int, group: list[str], inherited: list[str]) -> DataFrame:
    """Nodes of level k joined to the node of the next level that contains them: its children less
    the node's own interval are the siblings, and its path goes on from there."""
    a, b = (rows.withColumn("_bucket", _bucket(k)) for rows in (nodes, parents))
    inside = (b["lo"] <= a["lo"]) & (a["hi"] <= b["hi"])
    joined = a.join(b, same(a, b, group) & (a["_bucket"] == b["_bucket"]) & inside)
    before = F.filter(b["children"], lambda c: c["hi"] <= a["lo"])
    after = F.filter(b["children"], lambda c: c["lo"] >= a["hi"])
    step = F.struct(F.array_join(F.transform(before, lambda c: c["digest"]), "").alias("left"),
                    F.array_join(F.transform(after, lambda c: c["digest"]), "").alias("right"))
    return joined.select(*[a[c] for c in nodes.columns], *[b[c] for c in inherited], F.concat(F.array(step), b["path"]).alias("path"))
