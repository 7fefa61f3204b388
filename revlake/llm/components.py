"""Connected components of a graph given as rows of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from every id in *edges* (a, b).

    Large-star and small-star contraction: every round replaces the edges by ones to smaller ids, so that they end as
    stars around the smallest ids, in a number of rounds that grows with the logarithm of the size of the graph.
    Each round is an aggregation for the smallest neighbour and an equi-join; neither gathers a node's neighbours.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(edges):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        # Every larger neighbour gets an edge to the smallest one.
        large = (
            both.where("b > a").join(least, F.col("a") == F.col("k"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        down = written(large, "edges")
        # So does every smaller neighbour, and the node itself.
        small = down.groupBy("a").agg(F.min("b").alias("m"))
        linked = (
            down.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.select("a", F.col("m").alias("b")))
        )
        edges = written(linked.distinct(), "edges")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge, to an end that is never a larger one."""
    twice = edges.groupBy("a").count().where("count > 1").select("a")
    middle = edges.select(F.col("b").alias("a")).join(edges, "a", "left_semi")
    return twice.union(middle).isEmpty()


def joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further *links* (a, b); only the components that these touch are worked on."""
    def of(side: str) -> DataFrame:
        return parts.select(F.col("id").alias(side), F.col("component").alias(f"of_{side}"))

    lifted = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    moved = components(lifted).select(F.col("id").alias("old"), F.col("component").alias("new"))
    kept = parts.join(moved, F.col("component") == F.col("old"), "left").select("id", F.coalesce("new", "component").alias("component"))
    # Ends that were in no component before.
    fresh = moved.join(parts, F.col("old") == F.col("id"), "left_anti").select(F.col("old").alias("id"), F.col("new").alias("component"))
    return written(kept.union(fresh), "parts")
