"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from metaloom.operators.joins import skew_safe_join
from metaloom.session import stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of each node (the larger ones, or the smaller ones and itself) move to its least.

    Edges ``(a, b)`` have ``a < b``. The least neighbour is a map-side combined ``min``, joined back, so that
    the edges of a node with very many neighbours can be split over tasks.
    """
    if large:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
    else:
        both = edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
    least = both.groupBy("node").agg(F.min("near").alias("least"))
    least = least.withColumn("least", F.least("least", "node"))
    moved = skew_safe_join(both, least, ["node"], "inner")
    if large:
        made = moved.filter("near > node").select(F.col("least").alias("a"), F.col("near").alias("b"))
    else:
        made = moved.select(F.col("least").alias("a"), F.col("near").alias("b")).unionByName(
            least.select(F.col("least").alias("a"), F.col("node").alias("b"))
        )
    return made.filter("a < b")


def stars(links: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` of ``links(a, b)``'s components as stars: from the least node of each to all its others.

    Steps are written to the shared folder, and end when every edge leads to a node that has no smaller
    neighbour and the edges are stars. An empty table of links gives no rows. Links with a null end or with
    equal ends are ignored, and repeated ones count once.
    """
    ordered = links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stage(ordered.distinct(), "links")
    while True:
        # one grouping tells of every node how many edges end in it, and whether one begins there
        ends = edges.select(F.col("b").alias("node"), F.lit(0).alias("begins"), F.lit(1).alias("ends")).unionByName(
            edges.select(F.col("a").alias("node"), F.lit(1).alias("begins"), F.lit(0).alias("ends"))
        )
        seen = ends.groupBy("node").agg(F.max("begins").alias("begins"), F.sum("ends").alias("ends"))
        if not seen.filter("ends > 1 OR ends = 1 AND begins = 1").limit(1).count():
            return edges
        edges = stage(_stars(_stars(edges, True), False).distinct(), "links")


def rooted(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``stars``."""
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; ``root`` is the least node reachable. See ``stars``."""
    return rooted(stars(links))
