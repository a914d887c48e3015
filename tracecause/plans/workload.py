"""Observation tables built from the order tables.

``order_facts`` has one row per order, ``daily`` one row per day. Both have real parent-to-child
structure: a calendar flag drives the number of orders, orders bring lines, lines bring value, value
brings discount, and net is exactly value minus discount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecause.operators.graph import CausalGraph

DAILY_GRAPH = CausalGraph((("peak", "n_orders"), ("n_orders", "n_lines"), ("n_lines", "qty"), ("n_lines", "gross"),
                           ("gross", "disc"), ("gross", "net"), ("disc", "net")))
ORDER_GRAPH = CausalGraph((("n_lines", "qty"), ("n_lines", "gross"), ("gross", "disc"), ("gross", "net"),
                           ("disc", "net")))
SPLIT = "1998-04-15"
KEY = "d"
IDS_A_TASK = 250_000  # pairs of ids that one task keeps in memory to tell repeats


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with zeros for an order without lines.

    Lines are folded per order before the join, so the join sees one row per order on both sides and reuses the
    partitioning of the fold."""
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"),
                  F.sum("l_extendedprice").alias("gross"),
                  F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("disc")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    rows = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").fillna(0, ["n_lines", "qty", "gross", "disc"])
    return rows.select("o_orderkey", "d", "n_lines", "qty", "gross", "disc", (F.col("gross") - F.col("disc")).alias("net"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = (order_facts(spark, sf_dir).groupBy("d")
            .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("n_lines").alias("n_lines"), F.sum("qty").alias("qty"),
                 F.sum("gross").alias("gross"), F.sum("disc").alias("disc")))
    return days.select("d", F.month("d").isin(11, 12).alias("peak"), "n_orders", "n_lines", "qty", "gross", "disc",
                       (F.col("gross") - F.col("disc")).alias("net"))


def supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who an order depends on: region to nation to customer and supplier, and both to the order.

    Repeated edges are dropped as pairs of ids, before the longer names are made; kinds of edges never
    coincide, so their union needs no further check. The pairs are dealt out by their number: partitions of few
    bytes hold many of them, and each is kept in memory along with what is grouped next.
    """
    stacked = None
    for source, parent, child, parent_id, child_id in (
            ("nation", "region", "nation", "n_regionkey", "n_nationkey"),
            ("customer", "nation", "customer", "c_nationkey", "c_custkey"),
            ("supplier", "nation", "supplier", "s_nationkey", "s_suppkey"),
            ("orders", "customer", "order", "o_custkey", "o_orderkey"),
            ("lineitem", "supplier", "order", "l_suppkey", "l_orderkey")):
        rows = table(spark, sf_dir, source)
        ids = (rows.select(parent_id, child_id).dropna()
               .repartition(-(-rows.count() // IDS_A_TASK) or 1, parent_id, child_id).distinct())
        named = ids.select(*[F.concat(F.lit(kind + ":"), F.col(c).cast("string")).alias(role) for role, kind, c in (
            ("parent", parent, parent_id), ("child", child, child_id))])
        stacked = named if stacked is None else stacked.unionByName(named)
    return stacked
