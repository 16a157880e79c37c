"""Survey group F: text, vectors and models."""

from ..catalog import register, tables
from ..operators import models, text_vectors


@register("language_tfidf", "P27", sql=r"""
WITH t AS (SELECT doc_id, lang, unnest(string_split_regex(lower(text), '[ \t\r\n]+')) AS token
           FROM documents),
tf AS (SELECT doc_id, lang, token, count(*) AS tf FROM t WHERE token <> '' GROUP BY doc_id, lang, token),
df AS (SELECT lang, token, count(*) AS df FROM tf GROUP BY lang, token),
n AS (SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang)
SELECT tf.doc_id, tf.lang, tf.token, tf.tf, df.df,
       floor(tf.tf * ln((1 + n.n_docs) / (1 + df.df)) * 1e6 + 0.5) / 1e6 AS weight
FROM tf JOIN df ON tf.lang = df.lang AND tf.token = df.token JOIN n ON tf.lang = n.lang
""")
def q_language_tfidf(spark, sf_dir):
    """TF-IDF weight per document and token, document frequency per language."""
    return text_vectors.tfidf(tables(spark, sf_dir, "documents")["documents"])


@register("centroid_neighbours", "P28", sql="""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT label, unnest(v) AS x, unnest(generate_series(1, len(v))) AS d FROM e),
c AS (SELECT label, list(m ORDER BY d) AS q
      FROM (SELECT label, d, avg(x) AS m FROM p GROUP BY label, d) t GROUP BY label),
s AS (SELECT c.label AS query_label, e.vec_id,
             floor(list_dot_product(c.q, e.v)
                   / (sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(c.q, c.q))) * 1e6 + 0.5) / 1e6
               AS score
      FROM e CROSS JOIN c)
SELECT query_label, vec_id, score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_label ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s) t
WHERE rank <= 5
""")
def q_centroid_neighbours(spark, sf_dir):
    """Five vectors nearest (cosine) to each label's centroid."""
    return text_vectors.nearest_to_centroids(tables(spark, sf_dir, "embeddings")["embeddings"], 5)


@register("near_duplicate_documents", "P29", sql=r"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[ \t\r\n]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
                                   ELSE array_to_string(w[p:p + 2], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS p FROM t WHERE len(w) > 0) x),
s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id, b.doc_id AS dup_of, count(*) AS both
      FROM g a JOIN g b ON a.g = b.g AND b.doc_id < a.doc_id GROUP BY a.doc_id, b.doc_id),
j AS (SELECT o.doc_id, o.dup_of, o.both / CAST(x.n + y.n - o.both AS DOUBLE) AS jaccard
      FROM o JOIN s x ON o.doc_id = x.doc_id JOIN s y ON o.dup_of = y.doc_id
      WHERE 10 * o.both >= 8 * (x.n + y.n - o.both))
SELECT doc_id, min(dup_of) AS dup_of, floor(arg_min(jaccard, dup_of) * 1e6 + 0.5) / 1e6 AS jaccard
FROM j GROUP BY doc_id
""")
def q_near_duplicate_documents(spark, sf_dir):
    """For each document, the smallest document it is a near-duplicate of
    (Jaccard >= 0.8 of word 3-grams), if one is smaller."""
    return text_vectors.near_duplicates(tables(spark, sf_dir, "documents")["documents"])


@register("embedding_kmeans", "P30")
def q_embedding_kmeans(spark, sf_dir):
    """k-means (k = 10) cluster of every embedding vector."""
    out, _ = models.kmeans_groups(tables(spark, sf_dir, "embeddings")["embeddings"], k=10, seed=42)
    return out


@register("quality_model_holdout", "P31")
def q_quality_model_holdout(spark, sf_dir):
    """Logistic quality model: held-out predictions on the hash split."""
    t = tables(spark, sf_dir, "labels", "documents")
    rows = t["labels"].join(t["documents"].select("doc_id", "n_chars"), "doc_id")
    out, _ = models.quality_model(rows)
    return out
