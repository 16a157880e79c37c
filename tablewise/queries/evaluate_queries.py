"""Survey group E: evaluation."""

from pyspark.sql import functions as F

from ..catalog import register, tables
from ..operators import evaluate

# Fixed value: documents at least this long are predicted high quality.
LENGTH_THRESHOLD = 1000


def _labelled(spark, sf_dir):
    t = tables(spark, sf_dir, "labels", "documents")
    return t["labels"].join(t["documents"].select("doc_id", "n_chars"), "doc_id")


@register("length_quality_auc", "P24", sql="""
WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS score, quality AS y
           FROM labels JOIN documents ON labels.doc_id = documents.doc_id),
r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS avg_rank
      FROM d),
s AS (SELECT sum(CASE WHEN y = 1 THEN avg_rank ELSE 0 END) AS rank_sum,
             count(*) FILTER (WHERE y = 1) AS positives, count(*) FILTER (WHERE y <> 1) AS negatives FROM r)
SELECT floor((rank_sum - positives * (positives + 1) / 2.0::DOUBLE)
             / nullif(CAST(positives * negatives AS DOUBLE), 0) * 1e9 + 0.5) / 1e9 AS auc,
       positives, negatives
FROM s
""")
def q_length_quality_auc(spark, sf_dir):
    """ROC AUC of document length as a score for the quality label."""
    return evaluate.auc_rank_sum(_labelled(spark, sf_dir), "n_chars", "quality")


@register("length_quality_confusion", "P25", sql=f"""
WITH d AS (SELECT n_chars >= {LENGTH_THRESHOLD} AS pred, quality = 1 AS y
           FROM labels JOIN documents ON labels.doc_id = documents.doc_id),
c AS (SELECT count(*) FILTER (WHERE pred AND y) AS tp, count(*) FILTER (WHERE pred AND NOT y) AS fp,
             count(*) FILTER (WHERE NOT pred AND y) AS fn, count(*) FILTER (WHERE NOT pred AND NOT y) AS tn
      FROM d)
SELECT tp, fp, fn, tn,
       floor(CAST(tp AS DOUBLE) / nullif(tp + fp, 0) * 1e9 + 0.5) / 1e9 AS precision,
       floor(CAST(tp AS DOUBLE) / nullif(tp + fn, 0) * 1e9 + 0.5) / 1e9 AS recall
FROM c
""")
def q_length_quality_confusion(spark, sf_dir):
    """Confusion counts, precision and recall of 'long means good'."""
    return evaluate.confusion(_labelled(spark, sf_dir), F.col("n_chars") >= LENGTH_THRESHOLD, "quality")


def _sr(x, d=6):
    return f"floor(({x}) * 1e{d} + 0.5) / 1e{d}"


@register("click_view_welch", "P26", sql=f"""
WITH s AS (
  SELECT count(value) FILTER (WHERE event_type = 'click') AS n_a,
         count(value) FILTER (WHERE event_type = 'view') AS n_b,
         CAST(sum(CAST(value AS DECIMAL(38,10))) FILTER (WHERE event_type = 'click') AS DOUBLE)
           / count(value) FILTER (WHERE event_type = 'click') AS mean_a,
         CAST(sum(CAST(value AS DECIMAL(38,10))) FILTER (WHERE event_type = 'view') AS DOUBLE)
           / count(value) FILTER (WHERE event_type = 'view') AS mean_b,
         var_samp(value) FILTER (WHERE event_type = 'click') AS va,
         var_samp(value) FILTER (WHERE event_type = 'view') AS vb
  FROM events WHERE event_type IN ('click', 'view'))
SELECT n_a, n_b, {_sr('mean_a')} AS mean_a, {_sr('mean_b')} AS mean_b,
       {_sr('(mean_a - mean_b) / sqrt(va / n_a + vb / n_b)')} AS t,
       {_sr('(va / n_a + vb / n_b) * (va / n_a + vb / n_b) / ((va / n_a) * (va / n_a) / (n_a - 1) + (vb / n_b) * (vb / n_b) / (n_b - 1))')} AS dof
FROM s
""")
def q_click_view_welch(spark, sf_dir):
    """Welch's t-test of event value, clicks against views."""
    return evaluate.welch_t(tables(spark, sf_dir, "events")["events"], "value", "event_type", "click", "view")
