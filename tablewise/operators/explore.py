"""Exploration: column profile, quartiles and outliers, histogram,
correlation matrix, straight-line fit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import fine_mean, safe_div, stable_round
from ..plans.broadcast import broadcast_per_group
from ..plans.keys import join_on_keys
from ..plans.ranking import exact_percentiles

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def profile(df: DataFrame, columns: Sequence[str] | None = None, approx_distinct: bool = False,
            digits: int = 6) -> DataFrame:
    """One row per column: rows, nulls, distinct values, and for numeric
    columns min, max, mean and sample standard deviation (null otherwise).
    Statistics are doubles: whole numbers are exact up to 2^53.

    Moments come from one aggregate over one scan (partial aggregation, no
    column or value skew matters). Exact distinct counts are one
    `select(c).distinct()` per column, unioned: each reads one Parquet
    column, de-duplicates map-side and shuffles only distinct values --
    far cheaper than the row expansion Spark uses for several
    `count(DISTINCT)` in one aggregate. ``approx_distinct=True`` uses
    HyperLogLog++ sketches inside the single aggregate instead.
    """
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        col = F.col(c)
        aggs.append(F.count(col).alias(f"_nn{i}"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(col).alias(f"_d{i}"))
        if isinstance(types[c], _NUMERIC):
            x = col.cast("double")
            # Extremes of the column itself: whole numbers keep their order
            # beyond 2^53. Long and double sums stay in generated code.
            whole = isinstance(types[c], _WHOLE)
            aggs += [F.min(col).cast("double").alias(f"_min{i}"), F.max(col).cast("double").alias(f"_max{i}"),
                     (F.avg(x) if whole else fine_mean(x)).alias(f"_avg{i}"), F.stddev_samp(x).alias(f"_sd{i}")]
    wide = df.agg(*aggs)
    null_d = F.lit(None).cast("double")
    rows = []
    for i, c in enumerate(columns):
        numeric = isinstance(types[c], _NUMERIC)
        fields = [F.lit(c).alias("column_name"), F.col("_rows").alias("rows"),
                  (F.col("_rows") - F.col(f"_nn{i}")).alias("nulls")]
        if approx_distinct:
            fields.append(F.col(f"_d{i}").cast("bigint").alias("distinct_values"))
        fields += [
            (stable_round(F.col(f"_min{i}"), digits) if numeric else null_d).alias("min_value"),
            (stable_round(F.col(f"_max{i}"), digits) if numeric else null_d).alias("max_value"),
            (stable_round(F.col(f"_avg{i}"), digits) if numeric else null_d).alias("mean"),
            (stable_round(F.col(f"_sd{i}"), digits) if numeric else null_d).alias("stddev"),
        ]
        rows.append(F.struct(*fields))
    stats = wide.select(F.inline(F.array(*rows)))
    if approx_distinct:
        return stats
    distinct = reduce(DataFrame.unionByName, [
        df.select(c).distinct().agg(F.lit(c).alias("column_name"),
                                    F.count(F.col(c)).alias("distinct_values"))
        for c in columns])
    return stats.join(distinct, "column_name").select(
        "column_name", "rows", "nulls", "distinct_values", "min_value", "max_value", "mean", "stddev")


def iqr_outliers(df: DataFrame, value: str, group: str, id_col: str, k: float = 1.5,
                 digits: int = 6, approx_accuracy: int | None = None) -> DataFrame:
    """Per group quartiles (interpolated, exact) and, per row, whether the
    value lies outside [q1 - k*IQR, q3 + k*IQR].

    Quartiles come from `exact_percentiles`, which never gathers a group in
    one task; the per-group table (one row per group) is written once and
    joined back, broadcast when its size check passes.

    ``approx_accuracy`` switches to `percentile_approx`: a quantile sketch
    per group, built map-side and merged, so memory per group is bounded
    and there is no global sort. Each quartile is then a value of the group
    whose rank is within n / ``approx_accuracy`` of the exact rank (no
    interpolation).

    NaN values take no part in the quartiles and are flagged null.
    """
    nan = F.isnan(F.col(value).cast("double"))
    known = df.where(~F.coalesce(nan, F.lit(False)))
    if approx_accuracy:
        q = (known.groupBy(group)
             .agg(F.percentile_approx(F.col(value), [0.25, 0.75], approx_accuracy).alias("_q"))
             .select(group, F.col("_q")[0].cast("double").alias("q1"),
                     F.col("_q")[1].cast("double").alias("q3")))
    else:
        q = exact_percentiles(known, value, [0.25, 0.75], [group]).withColumnRenamed("p25", "q1") \
            .withColumnRenamed("p75", "q3")
    iqr = F.col("q3") - F.col("q1")
    out = (join_on_keys(df.select(id_col, group, value), broadcast_per_group(q), [group])
           .withColumn("is_outlier", F.when(~nan, (F.col(value) < F.col("q1") - k * iqr) |
                                            (F.col(value) > F.col("q3") + k * iqr))))
    return out.select(id_col, group, value, F.round("q1", digits).alias("q1"),
                      F.round("q3", digits).alias("q3"), "is_outlier")


def histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts in `bins` equal-width bins over [lo, hi) (`width_bucket`): bin 0
    holds values below lo, bin bins+1 values at or above hi. Only non-empty
    bins appear."""
    width = (hi - lo) / bins
    b = F.width_bucket(F.col(value), F.lit(lo), F.lit(hi), F.lit(bins))
    return (df.where(F.col(value).isNotNull())
            .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin",
                    (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("bin_lo"),
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_hi"),
                    "n"))


def correlation_pairs(df: DataFrame, columns: Sequence[str], digits: int = 9) -> DataFrame:
    """Pearson correlation of every pair of ``columns`` in long form
    (col_a, col_b, corr), from one aggregate over one scan. Rows where
    either value is null do not count; null when either column is constant."""
    pairs = list(combinations(columns, 2))
    aggs = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        aggs.append(safe_div(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(f"_c{i}"))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                     F.round(F.col(f"_c{i}"), digits).alias("corr"))
            for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))


def linear_fit(df: DataFrame, y: str, x: str, group: str, digits: int = 6) -> DataFrame:
    """Least-squares line y = slope * x + intercept per group, with R^2 and n.
    Uses the SQL regression aggregates, which merge partial moments."""
    return (df.groupBy(group)
            .agg(F.round(F.regr_slope(F.col(y), F.col(x)), digits).alias("slope"),
                 F.round(F.regr_intercept(F.col(y), F.col(x)), digits).alias("intercept"),
                 F.round(F.regr_r2(F.col(y), F.col(x)), digits).alias("r2"),
                 F.regr_count(F.col(y), F.col(x)).cast("bigint").alias("n")))
