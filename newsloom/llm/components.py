"""Connected components of links that may be many: alternating stars on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select(
        "a", F.least("a", "low").alias("low")
    )
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether links (a, b), a > b, are stars already: each node has one smaller neighbour, which has none itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    both = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return both.where(F.col("down") + F.col("up") > 1).where("down > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component): the least id reachable, for every linked node.

    Each round is written to the shared folder, which cuts the lineage. The
    rounds end when the links are stars, so that every node is tied to the least
    one of its component; their number grows with the logarithm of the longest path.
    """
    edges = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while not _is_done(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
