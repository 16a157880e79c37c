"""Exact positions and percentiles without a single-task window.

A window ordered over a whole group sends that group to one task; with a
group holding a third of all rows that task holds a third of the data.
Instead the rows are range-partitioned on the full sort key, which splits
even one hot group into contiguous slices. Each row's position is its
position inside its slice (the low 33 bits of
`monotonically_increasing_id`, taken right after `sortWithinPartitions`)
plus the number of rows in earlier slices. The slice-size table has one row
per partition, so it is bounded by the partition count and broadcast.

The numbered rows are written with `checkpoint()` to the session's shared
checkpoint folder before they are used twice (slice sizes, then positions).
Range bounds come from sampling, and Spark re-samples badly balanced inputs
with a seed tied to the RDD, so two evaluations of the same plan may split
the rows differently; the checkpoint fixes one split for every later use and
also means a lost executor recomputes nothing inconsistent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .broadcast import broadcast_per_group
from .lineage import materialize

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row number


def numbered_slices(df: DataFrame, order: Sequence[Column | str],
                    num_partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted on ``order``, tagged with their slice
    (``_pid``) and ``_mid``; checkpointed (see the module note).

    Range partitioning sends equal keys to one slice, so a value held by a
    third of the rows would make one slice a third of the data. A
    tie-breaker -- the row's position in the input, `monotonically_
    increasing_id` -- is appended to the range key, so runs of equal keys
    are cut into slices like any other range.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    keyed = df.withColumn("_tb", F.monotonically_increasing_id())
    full = [*order, F.col("_tb")]
    # Without an explicit count the range shuffle is sized by adaptive
    # execution: it starts from the shuffle (or initial) partition number and
    # coalesces neighbouring ranges to the advisory size, which keeps the
    # order contiguous.
    ranged = (keyed.repartitionByRange(num_partitions, *full) if num_partitions
              else keyed.repartitionByRange(*full))
    tagged = (ranged.sortWithinPartitions(*full)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .drop("_tb"))
    return materialize(tagged)


def global_row_index(df: DataFrame, order: Sequence[Column | str], index_col: str = "_idx",
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``index_col``: the 0-based position of each row in the total order
    ``order`` over the whole frame. Rows equal on ``order`` get distinct,
    adjacent positions."""
    tagged = numbered_slices(df, order, num_partitions)
    # One row per slice: safe to order globally and to broadcast.
    offsets = (tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_off", F.coalesce(
                   F.sum("_n").over(Window.orderBy("_pid")
                                    .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
               .select("_pid", "_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _ROW_BITS)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(index_col, F.col("_off") + local)
            .drop("_pid", "_mid", "_off"))


def running_total(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in
    ``order`` (distinct). Totals per slice are added up over the slices, one
    row each; the window runs inside a slice."""
    tagged = numbered_slices(df, [order])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy("_pid").agg(F.sum(value).alias("_n"))
               .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_pid", "_off"))
    here = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (tagged.withColumn("_in", F.coalesce(F.sum(value).over(here), F.lit(0)))
            .join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_in")).drop("_pid", "_mid", "_off", "_in"))


def exact_percentiles(df: DataFrame, value: str, probs: Sequence[float],
                      group_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Linearly interpolated percentiles of ``value`` per group, identical to
    `percentile` / SQL `percentile_cont`: for n values sorted ascending the
    p-th percentile sits at position h = p * (n - 1) and is
    v[floor h] + (h - floor h) * (v[ceil h] - v[floor h]).

    Returns one row per group with a column ``p<100*p>`` per probability
    (``p25``, ``p75`` ...). Nulls in ``value`` are ignored. Work is two
    aggregates and one join on a unique position, so no group is ever
    gathered into one task.
    """
    group_cols = list(group_cols)
    vals = df.select(*group_cols, value).where(F.col(value).isNotNull())
    indexed = global_row_index(vals, [*group_cols, value], "_idx", num_partitions)
    # Rows of one group are contiguous in the global order.
    spans = indexed.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"),
                                             F.min("_idx").alias("_start"))
    prob_arr = F.array(*[F.lit(float(p)) for p in probs])
    wanted = (spans.select(*group_cols, "_n", "_start", F.explode(prob_arr).alias("_p"))
              .withColumn("_h", F.col("_p") * (F.col("_n") - 1))
              .withColumn("_lo", F.floor("_h").cast("long"))
              .withColumn("_hi", F.ceil("_h").cast("long"))
              .withColumn("_frac", F.col("_h") - F.col("_lo")))
    picks = (wanted.select(*group_cols, "_p", "_frac", "_lo", "_hi",
                           F.explode(F.array(F.col("_start") + F.col("_lo"),
                                             F.col("_start") + F.col("_hi"))).alias("_idx"))
             .dropDuplicates([*group_cols, "_p", "_idx"]))
    # Two rows per group and probability: written once and, when small,
    # broadcast, so the numbered rows are looked up without being shuffled.
    looked_up = indexed.select("_idx", F.col(value).alias("_v")).join(broadcast_per_group(picks), "_idx")
    per_p = (looked_up.groupBy(*group_cols, "_p", "_frac")
             .agg(F.min("_v").alias("_vlo"), F.max("_v").alias("_vhi")))
    interp = F.when(F.col("_frac") == 0, F.col("_vlo")).otherwise(
        F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo")))
    long = per_p.select(*group_cols, "_p", interp.alias("_q"))
    out = long.groupBy(*group_cols).agg(*[
        F.max(F.when(F.col("_p") == float(p), F.col("_q"))).alias(percentile_name(p)) for p in probs])
    return out


def percentile_name(p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return f"p{s}"
