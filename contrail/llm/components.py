"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import shared_table


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns a, b): root is the
    smallest node of its component.

    Every step keeps at most as many edges as it read; only minima per node are
    aggregated (partially, before the shuffle), so a node with any number of
    neighbours is never gathered in one group. Each round is written to the
    shared folder, which cuts the lineage.
    """
    current = shared_table(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    before = None
    while True:
        # Large star: every larger neighbour of a node goes to the node's smallest neighbour (or itself).
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: the smaller neighbours of a node, and the node, go to the smallest of them.
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = shared_table(small.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct(), name)
        state = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
