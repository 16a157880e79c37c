"""Aggregates that are stored once per finest group and merged to any level:
distinct counts (exact bitmaps, HyperLogLog) and quantiles (KLL)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.broadcast import broadcast_per_group
from ..plans.keys import join_on_keys
from ..plans.lineage import materialize


def _levels(dims: Sequence[str]) -> list[list[str]]:
    return [list(c) for n in range(len(dims), -1, -1) for c in combinations(dims, n)]


def _merged(cells: DataFrame, dims: Sequence[str], extra: Sequence[str], merge: Column) -> DataFrame:
    """``cells`` merged on every level of a cube over ``dims``, ``extra`` kept
    apart: dims (null where rolled up), ``level`` (`grouping_id` of dims),
    extra, ``merged``."""
    sets = [[F.col(c) for c in (*level, *extra)] for level in _levels(dims)]
    level = F.lit(0).cast("long")
    for c in dims:
        level = level * 2 + F.grouping(c)
    return (cells.groupingSets(sets, *dims, *extra).agg(merge.alias("merged"), level.cast("long").alias("level"))
            .select(*dims, "level", *extra, "merged"))


def bitmap_cells(df: DataFrame, dims: Sequence[str], ids: str) -> DataFrame:
    """One bitmap per finest group and run of 32,768 ids: the mergeable form
    of an exact distinct count of whole-number ``ids``. Best for ids that are
    close together; a bitmap is 4 KB however few bits it holds."""
    return (df.groupBy(*dims, F.bitmap_bucket_number(ids).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("_bits")))


def bitmap_cube(cells: DataFrame, dims: Sequence[str], out: str) -> DataFrame:
    """Exact distinct counts ``out`` on every level of the cube, from
    `bitmap_cells`: dims, level, out. The rows are not read again, and no
    level shuffles ids: bitmaps of the same run are merged."""
    merged = _merged(cells, dims, ["_bucket"], F.bitmap_or_agg("_bits"))
    return merged.groupBy(*dims, "level").agg(F.sum(F.bitmap_count("merged")).alias(out))


def sketch_cells(df: DataFrame, dims: Sequence[str], value: str, lg_k: int = 12) -> DataFrame:
    """One HyperLogLog sketch of 2**lg_k registers per finest group, for
    values of any type that can be hashed (whole numbers, strings, binary)."""
    return df.groupBy(*dims).agg(F.hll_sketch_agg(value, lg_k).alias("_sketch"))


def sketch_cube(cells: DataFrame, dims: Sequence[str], out: str) -> DataFrame:
    """Estimated distinct counts on every level of the cube, from
    `sketch_cells`: dims, level, out."""
    merged = _merged(cells, dims, [], F.hll_union_agg("_sketch"))
    return merged.select(*dims, "level", F.hll_sketch_estimate("merged").alias(out))


def sketch_error(lg_k: int, sigmas: float = 3.0) -> float:
    """Relative error of an estimate at ``sigmas`` standard deviations."""
    return sigmas * 1.04 / (1 << lg_k) ** 0.5


def distinct_cube(df: DataFrame, dims: Sequence[str], ids: str, out: str = "distinct_values",
                  lg_k: int = 12) -> DataFrame:
    """dims (null where rolled up), ``level``, the exact distinct count and
    ``sketch_close``: whether the HyperLogLog estimate lies within three
    standard deviations of it.

    The rows are aggregated once, with partial aggregation before the
    shuffle, to bitmaps and sketches per finest group, which are written and
    merged per level. Defined cases: null ids are not counted, and a group
    with no other ids counts 0; a null in ``dims`` is a value like any other,
    told from a rolled-up column by ``level``; empty inputs give no rows.
    """
    dims = list(dims)
    exact = bitmap_cube(materialize(bitmap_cells(df, dims, ids)), dims, out)
    close = sketch_cube(materialize(sketch_cells(df, dims, ids, lg_k)), dims, "_estimate")
    bound = F.greatest(F.col(out) * sketch_error(lg_k), F.lit(0.5))
    return (join_on_keys(exact, close, [*dims, "level"])
            .select(*dims, "level", out, (F.abs(F.col("_estimate") - F.col(out)) <= bound).alias("sketch_close")))


def quantile_cells(df: DataFrame, dims: Sequence[str], value: str, k: int = 400) -> DataFrame:
    """One KLL quantile sketch per finest group: bounded memory, one pass,
    merged in any order. Nulls are left out; a group without values has none."""
    x = F.col(value).cast("double")
    return df.where(x.isNotNull()).groupBy(*dims).agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("_sketch"))


def quantiles(cells: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Cells merged to the groups ``by`` (any part of their dims; none: all
    of them): by, ``n`` and a column ``q<100*p>`` per probability."""
    merged = cells.groupBy(*by).agg(F.kll_merge_agg_double("_sketch").alias("_s"))
    return merged.where(F.kll_sketch_get_n_double("_s") > 0).select(
        *by, F.kll_sketch_get_n_double("_s").alias("n"),
        *[F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(f"q{100 * p:g}") for p in probs])


def rank_errors(df: DataFrame, found: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """By, ``n`` and, per probability, ``error<100*p>``: how far the share of
    values in the group that are smaller than the quantile (or equal to it,
    if that is closer) is from p. One pass over the rows with the quantiles,
    one row per group, joined back."""
    keys = list(by) or ["_all"]
    df, found = (d if by else d.withColumn("_all", F.lit(0)) for d in (df, found))
    q = broadcast_per_group(found.select(*keys, *[f"q{100 * p:g}" for p in probs]))
    x = F.col(value).cast("double")
    joined = join_on_keys(df.where(x.isNotNull()).select(*keys, x.alias("_x")), q, keys)
    n = F.count(F.lit(1))

    def error(p: float) -> Column:
        name = F.col(f"q{100 * p:g}")
        below, upto = F.count_if(F.col("_x") < name) / n, F.count_if(F.col("_x") <= name) / n
        return F.greatest(below - p, F.lit(p) - upto, F.lit(0.0)).alias(f"error{100 * p:g}")
    return joined.groupBy(*keys).agg(n.alias("n"), *[error(p) for p in probs]).drop("_all")
