"""Model evaluation: ROC AUC by rank sums, confusion counts, Welch's t."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, safe_div, stable_round
from ..plans.ranking import running_total


def auc_rank_sum(df: DataFrame, score: str, label: str, digits: int = 9) -> DataFrame:
    """Area under the ROC curve by the Mann-Whitney rank sum, ties given
    their average rank: AUC = (sum of positive ranks - P(P+1)/2) / (P N).

    Rows are counted per distinct score first, map-side. A positive at a
    score ranks above the negatives of smaller scores and half of those of
    its own, so what is needed is a running count of negatives over the
    distinct scores (`running_total`, no single-task window). Products are
    decimals, which do not overflow. One row: auc, positives, negatives.
    """
    rows = df.select(F.col(score).cast("double").alias("_s"), F.col(label).cast("int").alias("_y")) \
        .where(F.col("_s").isNotNull() & F.col("_y").isNotNull())
    per_score = rows.groupBy("_s").agg(F.count_if(F.col("_y") == 1).alias("_pos"),
                                       F.count_if(F.col("_y") != 1).alias("_neg"))
    ranked = running_total(per_score, "_s", "_neg", "_below")
    whole = "decimal(19,0)"
    twice = F.col("_pos").cast(whole) * (2 * F.col("_below") + F.col("_neg")).cast(whole)
    tot = ranked.agg(F.sum(twice.cast("double")).alias("_u2"),
                     F.coalesce(F.sum("_pos"), F.lit(0)).cast("bigint").alias("positives"),
                     F.coalesce(F.sum("_neg"), F.lit(0)).cast("bigint").alias("negatives"))
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    auc = safe_div(F.col("_u2"), 2 * pairs)
    return tot.select(stable_round(auc, digits).alias("auc"), "positives", "negatives")


def confusion(df: DataFrame, predicted: Column, label: str, digits: int = 9) -> DataFrame:
    """Confusion counts and precision / recall for a boolean prediction
    against a 0/1 label; one aggregate row."""
    y = F.col(label) == 1
    pred = predicted

    def cnt(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    c = df.agg(cnt(pred & y).alias("tp"), cnt(pred & ~y).alias("fp"),
               cnt(~pred & y).alias("fn"), cnt(~pred & ~y).alias("tn"))
    return c.select("tp", "fp", "fn", "tn",
                    stable_round(safe_div(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), digits)
                    .alias("precision"),
                    stable_round(safe_div(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), digits)
                    .alias("recall"))


def welch_t(df: DataFrame, value: str, group: str, a: str, b: str, digits: int = 6) -> DataFrame:
    """Welch's two-sample t statistic and Welch-Satterthwaite degrees of
    freedom for ``value`` between groups ``a`` and ``b``. The group filter
    reaches the Parquet scan; all moments come from one aggregate."""
    rows = df.where(F.col(group).isin(a, b))
    x = F.col(value).cast("double")

    def of(g):
        return F.when(F.col(group) == g, x)

    s = rows.agg(F.count(of(a)).alias("n_a"), F.count(of(b)).alias("n_b"),
                 exact_mean(of(a)).alias("mean_a"), exact_mean(of(b)).alias("mean_b"),
                 F.var_samp(of(a)).alias("_va"), F.var_samp(of(b)).alias("_vb"))
    sa = F.col("_va") / F.col("n_a")
    sb = F.col("_vb") / F.col("n_b")
    t = safe_div(F.col("mean_a") - F.col("mean_b"), F.sqrt(sa + sb))
    dof = safe_div((sa + sb) * (sa + sb),
                   sa * sa / (F.col("n_a") - 1) + sb * sb / (F.col("n_b") - 1))
    return s.select("n_a", "n_b", stable_round(F.col("mean_a"), digits).alias("mean_a"),
                    stable_round(F.col("mean_b"), digits).alias("mean_b"),
                    stable_round(t, digits).alias("t"), stable_round(dof, digits).alias("dof"))
