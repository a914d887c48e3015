"""Connected components of a graph of any size by alternating stars; no part of it reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecause.llm.common import cut_lineage


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the root is the smallest node reachable.

    Large and small stars alternate until nothing changes. Each step is a fold per node and a join, so a hub is
    pre-aggregated before the shuffle and its rows can be split afterwards; steps are cut in the shared folder.
    """
    links = (edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct())
    links = cut_lineage(links)
    before = None
    while True:
        links = cut_lineage(small_star(large_star(links)))
        state = links.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        before = state


def large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the least of its neighbours and itself."""
    both = links.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(
        links.select(F.col("u").alias("x"), F.col("v").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return (both.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
            .where("u < v").distinct())


def small_star(links: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the least of them."""
    least = links.groupBy("v").agg(F.min("u").alias("m"))
    moved = links.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u < v")
    return moved.unionByName(least.select("v", F.col("m").alias("u"))).distinct()
