"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketspark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node it reaches) for every node of ``links`` (a, b).

    Large and small stars take turns until only stars are left: a node tells its greater
    neighbours the least node of its neighbourhood, then its lesser ones. Each turn
    shuffles the links, with minima pre-aggregated, and is written to the shared folder, so
    a lost executor costs one turn; the number of turns grows with the logarithm of the
    longest path. Only whether links that are no stars remain comes to the driver. Loops,
    repeated links and links with nulls do no harm.
    """
    edges = links.where("a is not null and b is not null and a <> b")
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that the join can split the neighbours of a node that has very many.
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where("v > u").join(least, "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stored(large.distinct(), "large-stars")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        both = small.unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(both.where("u <> v").distinct(), "small-stars")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """No node has two lesser neighbours, and none that has one is such a neighbour itself."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up > 0 and down > 0)").isEmpty()
