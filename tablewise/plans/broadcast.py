"""Broadcast a join side only behind a checked size bound, in rows and bytes.

`F.broadcast` overrides Spark's own size threshold, so it is applied only
after measuring at most ``max_rows + 1`` rows of the side (a cheap limited
scan). Beyond a bound the side is returned unchanged: the join is then
planned as a shuffle join, and adaptive execution may still switch it to a
broadcast once runtime sizes are known (`autoBroadcastJoinThreshold`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimension sides up to this many rows and bytes are broadcast.
DEFAULT_MAX_ROWS = 100_000
DEFAULT_MAX_BYTES = 32 << 20


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` has at most ``max_rows`` rows, of at
    most ``max_bytes`` when written as JSON text, else ``df``."""
    size = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if size["rows"] <= max_rows and size["bytes"] <= max_bytes else df


def broadcast_per_group(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                        max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """A per-group table (one row per group, or per group and fold) that is
    joined back to every row: broadcast if it is within the bounds, so the
    large side streams through a broadcast hash join without being shuffled.
    (Adaptive execution could only switch to a broadcast after both sides
    had been shuffled.)

    At most ``max_rows + 1`` rows are fetched, which both measures the table
    and computes it once; within the bounds the fetched rows are what is
    broadcast. Nothing stays cached. Beyond them the join stays a shuffle
    join.
    """
    fetched = df.limit(max_rows + 1).toArrow()
    if fetched.num_rows > max_rows or fetched.nbytes > max_bytes:
        return df
    rows = df.sparkSession.createDataFrame(fetched.to_pylist(), df.schema)
    return F.broadcast(rows)
