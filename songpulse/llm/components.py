"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songpulse.llm.common import stage


def _least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the least of u and all its neighbours v.

    The minimum per node is combined before the shuffle; AQE splits the join of a hot node.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least around that node."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lower neighbours are linked to the least of them."""
    pairs = _least(edges).select("m", F.explode(F.array("u", "v")).alias("u"))
    return pairs.where("u != m").select("u", F.col("m").alias("v")).distinct()


def forest_roots(links: DataFrame) -> DataFrame:
    """(id, label) of every b in links (a, b) where a < b and no b comes twice: its root.

    Such links are a forest; every label is replaced by its own label until nothing changes, which
    takes the logarithm of the depth.
    """
    labels = stage(links.select(F.col("b").alias("id"), F.col("a").alias("label")), "roots")
    while True:
        up = labels.select(F.col("id").alias("label"), F.col("label").alias("up"))
        moved = stage(labels.join(up, "label", "left"), "roots")
        labels = moved.select("id", F.coalesce("up", "label").alias("label"))
        if moved.where("up is not null").isEmpty():
            return labels


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every node of links (a, b); label is the least node that it reaches.

    Each round's edges are written to the shared folder; rounds grow with the logarithm of the
    longest chain. NULLs link nothing; an empty table gives an empty result.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "components")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        edges = stage(_small_star(_large_star(edges)), "components")
    leaves = edges.select(F.col("u").alias("id"), F.col("v").alias("label"))
    return leaves.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
