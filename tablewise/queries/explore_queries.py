"""Survey group B: profile, quartiles, histogram, correlations, fits."""

from ..catalog import register, tables
from ..operators import explore

PROFILE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                   "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                   "l_shipdate")
_NUMERIC = PROFILE_COLUMNS[:8]


def _sr(x: str, d: int = 6) -> str:
    """SQL text of `stable_round`."""
    return f"floor(({x}) * 1e{d} + 0.5) / 1e{d}"


def _profile_sql() -> str:
    parts = []
    for c in PROFILE_COLUMNS:
        if c in _NUMERIC:
            mean = f"CAST(sum(CAST({c} AS DECIMAL(38,10))) AS DOUBLE) / count({c})"
            stats = (f"{_sr(f'min({c})::DOUBLE')}, {_sr(f'max({c})::DOUBLE')}, "
                     f"{_sr(mean)}, {_sr(f'stddev_samp({c}::DOUBLE)')}")
        else:
            stats = "NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE"
        parts.append(f"SELECT '{c}', count(*), count(*) - count({c}), count(DISTINCT {c}), {stats} "
                     f"FROM lineitem")
    return ("SELECT * FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) t(column_name, rows, nulls, "
            "distinct_values, min_value, max_value, mean, stddev)")


@register("lineitem_profile", "P05", sql=_profile_sql())
def q_lineitem_profile(spark, sf_dir):
    """Column profile of lineitem, one row per column."""
    return explore.profile(tables(spark, sf_dir, "lineitem")["lineitem"], PROFILE_COLUMNS)


@register("event_value_outliers", "P06", sql="""
WITH q AS (
  SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM events GROUP BY event_type)
SELECT event_id, event_type, value, round(q1, 6) AS q1, round(q3, 6) AS q3,
       (value < q1 - 1.5 * (q3 - q1)) OR (value > q3 + 1.5 * (q3 - q1)) AS is_outlier
FROM events JOIN q USING (event_type)
""")
def q_event_value_outliers(spark, sf_dir):
    """Quartiles per event type and the 1.5 x IQR outlier flag per event."""
    return explore.iqr_outliers(tables(spark, sf_dir, "events")["events"], "value", "event_type", "event_id")


@register("event_value_histogram", "P07", sql="""
SELECT bin, 0.0::DOUBLE + (bin - 1) * 25.0::DOUBLE AS bin_lo, 0.0::DOUBLE + bin * 25.0::DOUBLE AS bin_hi,
       count(*) AS n
FROM (SELECT CAST(CASE WHEN value < 0 THEN 0 WHEN value >= 500 THEN 21
                       ELSE floor(20 * (value - 0) / 500.0::DOUBLE) + 1 END AS BIGINT) AS bin
      FROM events) t
GROUP BY bin
""")
def q_event_value_histogram(spark, sf_dir):
    """Histogram of event values, 20 equal bins on [0, 500)."""
    return explore.histogram(tables(spark, sf_dir, "events")["events"], "value", 0.0, 500.0, 20)


CORR_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _corr_sql() -> str:
    from itertools import combinations
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS corr FROM lineitem"
        for a, b in combinations(CORR_COLUMNS, 2))


@register("lineitem_correlations", "P08", sql=_corr_sql())
def q_lineitem_correlations(spark, sf_dir):
    """Pairwise Pearson correlations of lineitem's numeric columns."""
    return explore.correlation_pairs(tables(spark, sf_dir, "lineitem")["lineitem"], CORR_COLUMNS)


@register("price_quantity_fit", "P09", sql="""
SELECT l_returnflag,
       round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2,
       CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n
FROM lineitem GROUP BY l_returnflag
""")
def q_price_quantity_fit(spark, sf_dir):
    """Straight-line fit of extended price on quantity per return flag."""
    return explore.linear_fit(tables(spark, sf_dir, "lineitem")["lineitem"],
                              "l_extendedprice", "l_quantity", "l_returnflag")
