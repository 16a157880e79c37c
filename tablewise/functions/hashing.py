"""Deterministic hash-based assignment (independent of partitioning)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: Column, buckets: int) -> Column:
    """Bucket in [0, buckets) from the first 8 hex digits of md5(key as
    string). The same key always lands in the same bucket, on any cluster
    and in any engine that has md5, unlike `randomSplit`."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets)).cast("int")
