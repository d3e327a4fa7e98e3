"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .stages import staged


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars around nodes that point nowhere: each node that points to
    another does so once, and nothing points to it."""
    ends = edges.select(F.col("src").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        edges.select("dst", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.where("out > 1 or (out > 0 and into > 0)").agg(F.count("*")).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least node around it."""
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
    moved = both.where("dst > src").join(least, "src")
    return moved.select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node, move to the least of them. ``src > dst``."""
    least = edges.groupBy("src").agg(F.min("dst").alias("low"))
    moved = edges.join(least, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.union(least.select("src", F.col("low").alias("dst"))).distinct()


def connected_components(links: DataFrame, src: str = "src", dst: str = "dst", name: str = "components") -> DataFrame:
    """Least node reachable from each node that has a link: (node, component).

    ``links`` are undirected pairs of long ids, in any order, repeats and loops allowed; a pair
    with a null is no link. Nodes without a link are absent. The steps only take minima and
    joins, so a node with very many links is aggregated before the shuffle and split by adaptive
    execution; every round is a written table, and the rounds grow with the logarithm of the
    longest path.
    """
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    edges = links.where(a.isNotNull() & b.isNotNull() & (a != b))
    edges = staged(edges.select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")).distinct(), name)
    while not _settled(edges):
        edges = staged(_small_star(_large_star(edges)), name)
    nodes = edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return nodes.union(edges.select("dst", "dst").distinct())
