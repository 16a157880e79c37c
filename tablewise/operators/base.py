"""Joins, rollups and top-k: the star-schema basics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import revenue
from ..plans.broadcast import bounded_broadcast


def nation_revenue(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                   nation: DataFrame) -> DataFrame:
    """Revenue sum(l_extendedprice * (1 - l_discount)) and line count per
    customer nation.

    Aggregation is pushed below each join (eager aggregation): lines collapse
    to one row per order map-side before the order join, and joined orders
    collapse to one row per customer before the customer join, so each
    shuffle carries at most one row per key per map task and a hot order or
    customer costs nothing extra. The per-order aggregate is already hash
    partitioned on the order key, so only `orders` is shuffled for that join.
    """
    per_order = (lineitem.groupBy("l_orderkey")
                 .agg(F.sum(revenue()).alias("rev"), F.count(F.lit(1)).alias("lines")))
    per_cust = (per_order
                .join(orders.select("o_orderkey", "o_custkey"),
                      per_order.l_orderkey == orders.o_orderkey)
                .groupBy("o_custkey")
                .agg(F.sum("rev").alias("rev"), F.sum("lines").alias("lines")))
    per_nation = (per_cust
                  .join(customer.select("c_custkey", "c_nationkey"),
                        per_cust.o_custkey == customer.c_custkey)
                  .groupBy("c_nationkey")
                  .agg(F.sum("rev").alias("rev"), F.sum("lines").alias("lines")))
    nations = bounded_broadcast(nation.select("n_nationkey", "n_name"))
    return (per_nation.join(nations, per_nation.c_nationkey == nations.n_nationkey)
            .select("n_name",
                    F.round("rev", 2).alias("revenue"),
                    F.col("lines").cast("bigint").alias("line_count")))


def orders_without_lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders that no line item references (NOT EXISTS).

    The line side is reduced to distinct order keys first; the partial
    aggregate removes repeats map-side, so a hot order key cannot swamp the
    anti join's partition.
    """
    keys = lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return (orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
            .join(keys, "o_orderkey", "left_anti"))


def customers_by_region(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customer counts by region and nation with subtotals (ROLLUP).

    Customers are counted per nation key first (partial + final aggregate,
    one row per nation), so the rollup and the dimension joins run on at most
    one row per nation however many customers there are.
    """
    per_nation = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    dims = (bounded_broadcast(nation.select("n_nationkey", "n_name", "n_regionkey"))
            .join(bounded_broadcast(region.select("r_regionkey", "r_name")),
                  F.col("n_regionkey") == F.col("r_regionkey")))
    return (per_nation.join(dims,
                            per_nation.c_nationkey == dims.n_nationkey)
            .rollup("r_name", "n_name")
            .agg(F.sum("n").cast("bigint").alias("customers"),
                 F.grouping_id().cast("int").alias("level")))


def top_orders_per_customer(orders: DataFrame, k: int = 3) -> DataFrame:
    """The k largest orders of each customer; ties broken by order key.

    `row_number() <= k` is planned with a partial WindowGroupLimit before the
    shuffle, so every map task forwards at most k rows per customer and a
    customer holding a third of all orders ships only k rows per task.
    """
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey"))
    return (orders.select("o_custkey", "o_orderkey", "o_totalprice")
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))
