"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweir.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the least node it reaches.

    Each round every node learns the least node among its neighbours' (large star) and
    points its neighbours at it (small star); a round is written before the next, and the
    last is the one that leaves stars only. The number of rounds grows with the logarithm
    of the longest chain; links that are stars from the start need none. A node with very many
    neighbours is one row of an aggregate, never one list. NULLs are no nodes.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stage(
        both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    while not _are_stars(edges):
        # Large star: neighbours above a node go to the least of it and its neighbours.
        ways = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = (
            ways.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = stage(large, "large-star")
        # Small star: neighbours below a node, and it, go to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                        F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                    )
                ).alias("e")
            )
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        edges = stage(small, "small-star")
    return _named(edges)


def _named(stars: DataFrame) -> DataFrame:
    least = F.col("b").alias("component")
    return stars.select(F.col("a").alias("node"), least).unionAll(
        stars.select(F.col("b").alias("node"), least).distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node above points at one node, which points at none. Edges go from
    the greater node to the less, so each star's middle is its least node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionAll(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.where("out > 1 OR (out = 1 AND into = 1)").isEmpty()
