"""Connected components of links between numbered nodes, as joins and sums.

Large-star and small-star steps alternate until all components are stars, when nothing can change: first every node links
its larger neighbours to the least node it knows, then its smaller ones. Both are a
grouped minimum, which shrinks before its shuffle, and a join back, which adaptive
execution splits at a hot node; no task holds a node's neighbours. Each round is written
below the shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.session import discard, written


def _least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least neighbour of u, or u itself."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a root or has one edge, to a root: nothing can change then."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("edges"), F.min("down").alias("least"))
    return nodes.where((F.col("edges") > 1) | ((F.col("edges") > 0) & (F.col("least") == 0))).limit(1).count() == 0


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b); the root is the least node that can be reached.

    Self-links and repeats are allowed; nodes are integers and not null. Without links
    the result is empty.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _least(large)
        small = small.select(F.col("u"), F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        before, edges = edges, written(small.where("u <> v").distinct(), "links")
        discard(before)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
