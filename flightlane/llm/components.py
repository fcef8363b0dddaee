"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlane.session import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label for every node of ``links`` (two long columns): the label is the least node that links reach.

    Large-star and small-star rounds: every node is linked to the least node around it until each
    component is a star around its least node, which takes about log(nodes) rounds. The least
    neighbour is an aggregate joined back, so a node with very many links is no group in one task.
    Each round is written to the shared folder. Rows with a null and links of a node to itself are
    ignored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v")
    edges = stored(edges.distinct(), "links")
    before = None
    while before != (before := _state(edges)):
        edges = stored(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _state(edges: DataFrame) -> tuple:
    both = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(both % (1 << 31)), F.bit_xor(both)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of a node to the least of it and its neighbours."""
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
