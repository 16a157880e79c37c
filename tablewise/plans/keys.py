"""Equi-joins on group keys that keep null keys.

A plain equi-join never matches a null key, so rows whose group column is
null would silently vanish when a per-group table is joined back to them,
although `groupBy` keeps null as a group of its own. `<=>` (null-safe
equality) is still planned as an equi-join (hash or sort-merge on the keys),
so nothing changes in the physical plan except that nulls match nulls.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null-safe equality, keeping one copy of each
    key column (the left one), like ``left.join(right, keys, how)``."""
    keys = list(keys)
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` whose hot keys adaptive execution can split.

    It splits a join only if both inputs come straight out of a shuffle. An
    aggregate grouped by the join keys does not: it is already partitioned
    as the join wants. A key derived from the others makes the join want a
    partitioning that the aggregate does not have, so its (few) rows are
    shuffled once more and both inputs qualify.

    The derived key is one of 128 numbers: a whole hash, which does not
    compress, would be most of a short row.
    """
    tag = F.pmod(F.xxhash64(*keys), F.lit(128)).cast("byte").alias("_jk")
    return left.select("*", tag).join(right.select("*", tag), [*keys, "_jk"], how).drop("_jk")
