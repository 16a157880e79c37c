"""Spread CPU-heavy per-row work over the cluster when the scan does not.

A Parquet file is split by row group. A file written as one row group is
read by one task however many cores there are, and everything fused into
that scan stage -- tokenising, shingling, hashing, the partial aggregate --
runs on one core. On a large input (many files and row groups) the scan
already has more tasks than cores and nothing is done here.

When the input has fewer partitions than the cluster's default parallelism,
rows are hash-partitioned on a key into that many partitions. Hash
partitioning (not round-robin) is deterministic under task retries without
a local sort, and an aggregate grouped by the same key (or by the key plus
more columns) then needs no second shuffle. The partition count is explicit,
so adaptive execution keeps it instead of merging small partitions back into
one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_by(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """``df`` hash-partitioned on ``key`` into ``min_partitions`` (default:
    the cluster's default parallelism) if it has fewer partitions, else
    ``df`` unchanged. Counting partitions plans the scan; it runs no job."""
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        partitions = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. a Spark Connect session): leave the plan as it is
        return df
    if partitions >= target:
        return df
    return df.repartition(target, key)
