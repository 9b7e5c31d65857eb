"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.tables import Stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour, or to itself."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # A join, not a window, so that a node with very many neighbours can be split.
    return near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> Stored:
    """Smallest node that each node of ``edges`` reaches: a table of node and component.

    ``edges`` has columns u and v of integers; loops, repeated edges and both directions may
    occur, nulls are left out. The smallest node of a component is in the result too. Each
    round is written to the scratch folder; rounds grow with the logarithm of the longest
    chain, and only whether to go on reaches the driver.
    """
    edges = edges.select("u", "v").filter("u <> v").distinct()
    current = Stored(edges, "components")
    while True:
        following = Stored(_small_star(_large_star(current.df)).distinct(), "components")
        current.drop()
        current = following
        # Done once every node has one centre, and no centre has one itself.
        several = current.df.groupBy("u").count().filter("count > 1").select("u")
        centres = current.df.select(F.col("v").alias("u"))
        moving = current.df.join(centres, "u", "left_semi").select("u")
        if not several.union(moving).limit(1).count():
            break
    stars = current.df
    found = Stored(
        stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select("v", "v").distinct()),
        "components",
    )
    current.drop()
    return found
