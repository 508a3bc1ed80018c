"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.session import shared_folder


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour.

    Very many nodes may give the same link; those of a task are one row before they are dealt out.
    """
    both = edges.union(edges.select(F.col("low").alias("high"), F.col("high").alias("low"))).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return both.where("other > node").join(least, "node").select(
        F.col("other").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
    own = least.select("high", F.col("least").alias("low"))
    return moved.where("high <> low").union(own).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) of every node that has an edge.

    `edges` has two long columns; loops, repeated and reversed edges do no harm, and an edge with a
    NULL end is ignored. Alternates two star operations, which shorten every path by half at least,
    until nothing changes. Each round is cut by a checkpoint; only counts and sums reach the driver,
    and joins on a node with very many edges are left to adaptive execution to split.
    """
    shared_folder(edges.sparkSession)
    a, b = edges.columns
    stars = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct().checkpoint()
    state = None
    while True:
        found = stars.agg(
            F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return stars.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
                stars.select("low", "low").distinct())
        state = tuple(found)
        stars = _small_star(_large_star(stars)).checkpoint()
