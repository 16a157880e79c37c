"""Connected components of a link table, distributed.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every node is pointed at the smallest
neighbour it knows until each component is one star around its smallest id.
Each step is one aggregate and one join over at most two rows per link; a
node with very many links is a key that partial aggregation and skew-join
splitting handle, its links are never collected. Nothing reaches the driver
but row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _point(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step. ``edges``: (a, b) with a > b, distinct. Large star:
    the larger neighbours of a node go to the smallest of its neighbours and
    itself. Small star: the smaller neighbours and the node itself do."""
    if larger_only:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        moved = (edges.select(F.col("b").alias("a"), F.col("a").alias("b"))  # larger neighbours b of a
                 .join(settle(low), "a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        return moved.distinct()
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    low = settle(low)
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every id that has a link; ``component`` is the
    smallest id reachable. ``links``: two long columns, any order, repeats
    and loops allowed; rows with a null are ignored."""
    x, y = links.columns
    edges = settle(links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"),
                                     (F.col(x).isNotNull() & F.col(y).isNotNull()).alias("ok"))
                        .where("ok and a > b").select("a", "b").distinct())
    while True:
        # A star forest: every node has one smaller neighbour, which has none.
        many = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1)
        chained = edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").limit(1)
        if not many.count() and not chained.count():
            break
        edges = settle(_point(settle(_point(edges, True)), False))
    return (edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()))
