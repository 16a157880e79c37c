"""Survey group C: rule checks, duplicates, JSON, pivot, splits, scaling,
target encoding."""

from ..catalog import register, tables
from ..operators import clean

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@register("rule_violations", "P10", sql="""
SELECT 'duplicate_line_key' AS rule, l_orderkey AS key_a, CAST(l_linenumber AS BIGINT) AS key_b,
       count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'line_without_order', l_orderkey, CAST(NULL AS BIGINT), count(*)
FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
GROUP BY l_orderkey
UNION ALL
SELECT 'order_without_customer', o_orderkey, o_custkey, CAST(1 AS BIGINT)
FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL
SELECT 'shipped_before_order', l_orderkey, CAST(l_linenumber AS BIGINT), count(*)
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate < o_orderdate
GROUP BY l_orderkey, l_linenumber
""")
def q_rule_violations(spark, sf_dir):
    """Duplicate line keys, orphan keys, lines shipped before their order."""
    t = tables(spark, sf_dir, "lineitem", "orders", "customer")
    return clean.rule_violations(t["lineitem"], t["orders"], t["customer"])


@register("exact_duplicate_documents", "P11", sql=r"""
WITH k AS (
  SELECT doc_id, md5(trim(regexp_replace(lower(text), '[ \t\r\n]+', ' ', 'g'))) AS key
  FROM documents),
g AS (
  SELECT key, min(doc_id) AS keep_id, count(*) AS copies FROM k GROUP BY key HAVING count(*) > 1)
SELECT doc_id, keep_id, copies FROM k JOIN g USING (key)
""")
def q_exact_duplicate_documents(spark, sf_dir):
    """Documents equal up to case and whitespace, with the lowest id kept."""
    return clean.exact_duplicates(tables(spark, sf_dir, "documents")["documents"])


@register("event_props_field", "P12", sql="""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_event_props_field(spark, sf_dir):
    """Integer field k parsed from the JSON text in events.props."""
    return clean.json_field(tables(spark, sf_dir, "events")["events"], "event_id", "props", "k int")


@register("daily_event_pivot", "P13", sql="""
SELECT CAST(ts AS DATE) AS day,
       count(*) FILTER (WHERE event_type = 'click') AS click,
       count(*) FILTER (WHERE event_type = 'error') AS error,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
       count(*) FILTER (WHERE event_type = 'signup') AS signup,
       count(*) FILTER (WHERE event_type = 'view') AS "view",
       count(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN
                        ('click', 'error', 'purchase', 'signup', 'view')) AS other
FROM events GROUP BY 1
""")
def q_daily_event_pivot(spark, sf_dir):
    """Events per day, one column per event type."""
    return clean.daily_pivot(tables(spark, sf_dir, "events")["events"], "ts", "event_type", EVENT_TYPES)


@register("document_split", "P14", sql="""
SELECT doc_id, fold, CASE WHEN fold < 8 THEN 'train' ELSE 'test' END AS split
FROM (SELECT doc_id,
             CAST(CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10 AS INTEGER) AS fold
      FROM documents) t
""")
def q_document_split(spark, sf_dir):
    """Reproducible 80/20 train/test split of documents by md5 of the id."""
    return clean.hash_split(tables(spark, sf_dir, "documents")["documents"], "doc_id")


@register("lineitem_standard_scores", "P15", sql="""
WITH s AS (
  SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq,
         avg(l_extendedprice) AS mp, stddev_samp(l_extendedprice) AS sp FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round((l_quantity - mq) / nullif(sq, 0), 6) AS z_l_quantity,
       round((l_extendedprice - mp) / nullif(sp, 0), 6) AS z_l_extendedprice
FROM lineitem CROSS JOIN s
""")
def q_lineitem_standard_scores(spark, sf_dir):
    """Standard scores of quantity and extended price per line."""
    return clean.standard_scores(tables(spark, sf_dir, "lineitem")["lineitem"],
                                 ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice"])


@register("language_target_encoding", "P16", sql="""
WITH k AS (
  SELECT l.doc_id, d.lang, CAST(l.doc_id % 5 AS INTEGER) AS fold, CAST(l.quality AS DOUBLE) AS y
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
f AS (SELECT lang, fold, sum(y) AS s_fold, count(y) AS c_fold FROM k GROUP BY lang, fold),
g AS (SELECT lang, sum(s_fold) AS s_all, sum(c_fold) AS c_all FROM f GROUP BY lang)
SELECT k.doc_id, k.lang, k.fold,
       round((g.s_all - f.s_fold) / nullif(g.c_all - f.c_fold, 0), 6) AS target_mean
FROM k JOIN f ON k.lang = f.lang AND k.fold = f.fold JOIN g ON k.lang = g.lang
""")
def q_language_target_encoding(spark, sf_dir):
    """Out-of-fold mean quality per language (target encoding)."""
    t = tables(spark, sf_dir, "labels", "documents")
    rows = t["labels"].join(t["documents"].select("doc_id", "lang"), "doc_id")
    return clean.out_of_fold_target_mean(rows, "doc_id", "lang", "quality")
