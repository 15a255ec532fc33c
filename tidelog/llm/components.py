"""Connected components of a large graph, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Stored, shuffled


def _hang(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is hung on the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(shuffled(least), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _pull(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node itself, are hung on the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(shuffled(least), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node named by ``links`` (columns u, v of one type).

    ``component`` is the smallest node reachable. Links may repeat, point either way or join
    a node to itself; rows with a null are ignored. Each round hangs larger nodes on smaller
    neighbours until all stars are flat; the number of rounds grows with the logarithm of the
    longest chain, and no group is ever gathered. Tables between rounds are written to the
    shared folder, so a lost executor repeats part of one round only.
    """
    nodes = links.where("u is not null and v is not null")
    edges = nodes.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current = Stored(edges.distinct(), "links")
    seen = None
    while True:
        following = Stored(_pull(_hang(current.df)), "links")
        state = following.df.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen is not None:
            current.delete()
        else:
            first = current
        current = following
        if state == seen:
            break
        seen = state
    found = current.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.df.select(F.col("v").alias("node")).distinct()
    alone = nodes.where("u = v").select(F.col("u").alias("node")).distinct()
    lone = alone.join(shuffled(found), "node", "left_anti").unionByName(roots).distinct()
    first.delete()
    return found.unionByName(lone.withColumn("component", F.col("node")))
