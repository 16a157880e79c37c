"""The registered queries of this package and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole
table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_quality_rules(spark, sf_dir):
    """Per document: the rule counts, the base verdict and the verdict with
    the certified cutoffs."""
    from .quality_rules import quality_rules
    out = quality_rules(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


@query
def op1_token_blocks(spark, sf_dir):
    """Token ids of every document, written in packed blocks and read back."""
    from pyspark.sql import functions as F

    from .token_blocks import fresh_path, read_tokens, write_tokens
    path = fresh_path(spark, "tokens")
    write_tokens(load(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_best_fit_packing(spark, sf_dir):
    """Place of every piece of every document in packed sequences."""
    from .packing import pack
    return pack(load(spark, sf_dir, "documents"))


@query
def op9_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    from .toxicity import toxicity
    return toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")) \
        .select("doc_id", "held_out", "score", "predicted")


@query
def op5_quality_mil(spark, sf_dir):
    """Quality score of every document."""
    from .quality_mil import quality_mil
    return quality_mil(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op6_piece_codec(spark, sf_dir):
    """SentencePiece ids of every document, with parity and round trip."""
    from pyspark.sql import functions as F

    from .pieces import encode_texts
    return encode_texts(load(spark, sf_dir, "documents")) \
        .select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), "parity", "round_trip")


def lines_of(text):
    from pyspark.sql import functions as F
    return F.size(F.split(F.coalesce(text, F.lit("")), "\n")).cast("long")


@query
def op8_line_dedup(spark, sf_dir):
    """Lines of every document, how many go with repeated three-line
    windows, and the SHA-256 of the text that is left."""
    from pyspark.sql import functions as F

    from .line_dedup import dedup_lines
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", lines_of(F.col("text")).alias("n_lines"))
    gone = F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long")
    return dedup_lines(docs).select("doc_id", "n_lines", gone.alias("n_removed"),
                                    F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL["op8_line_dedup"] = """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, pos, array_to_string(ls[pos + 1:pos + 3], chr(10)) AS win
      FROM (SELECT doc_id, ls, unnest(range(0, len(ls) - 2)) AS pos FROM l)),
f AS (SELECT win, min(struct_pack(d := doc_id, p := pos)) AS first FROM w GROUP BY win HAVING count(*) > 1),
later AS (
  SELECT doc_id, CASE WHEN first.d = doc_id THEN greatest(pos, first.p + 3) ELSE pos END AS a, pos + 2 AS b
  FROM w JOIN f USING (win) WHERE first.d <> doc_id OR first.p <> pos),
gone AS (SELECT DISTINCT doc_id, line FROM (SELECT doc_id, unnest(range(a, b + 1)) AS line FROM later)),
g AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
x AS (SELECT doc_id, unnest(ls) AS line_text, unnest(range(0, len(ls))) AS line FROM l),
kept AS (
  SELECT x.doc_id, string_agg(line_text, chr(10) ORDER BY x.line) AS t
  FROM x LEFT JOIN gone ON x.doc_id = gone.doc_id AND x.line = gone.line
  WHERE gone.line IS NULL GROUP BY x.doc_id)
SELECT l.doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM l LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op3_embedding_dedup(spark, sf_dir):
    """Links and component of every vector at cosine 0.95 or more."""
    from .vector_dedup import near_duplicate_vectors
    return near_duplicate_vectors(load(spark, sf_dir, "embeddings"))


@query
def op2_suffix_dedup(spark, sf_dir):
    """Bytes of every document covered by repeated 200-byte strings, and the
    SHA-256 of the rest."""
    from pyspark.sql import functions as F

    from .suffix_dedup import remove_repeats
    out = remove_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"), 200)
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return out.select("row.doc_id", "n_bytes", n.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_ngram_join(spark, sf_dir):
    """Shingle-set size and component of every document at Jaccard 0.9 of
    three-word shingles."""
    from .ngram_join import jaccard_components
    return jaccard_components(load(spark, sf_dir, "documents"), k=3, num=90, den=100)


# A-Z is lower-cased, other letters are not.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL["op4_ngram_join"] = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
                                   ELSE array_to_string(w[p:p + 2], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS p FROM t WHERE len(w) > 0) x),
s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
l AS (SELECT o.a, o.b
      FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both
            FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id) o
      JOIN s x ON o.a = x.doc_id JOIN s y ON o.b = y.doc_id
      WHERE 100 * o.both >= 90 * (x.n + y.n - o.both)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents
                 UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN s ON r.doc_id = s.doc_id GROUP BY r.doc_id
"""

ORACLE_SQL["op3_embedding_dedup"] = """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM e),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id <> y.vec_id AND x.n > 0 AND y.n > 0
      WHERE list_dot_product(x.v, y.v) / (x.n * y.n) >= 0.95),
d AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r(vec_id, c) AS (SELECT vec_id, vec_id FROM e UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id),
m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id)
SELECT m.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, component_id, m.vec_id = component_id AS kept
FROM m LEFT JOIN d ON m.vec_id = d.a
"""


@query
def op11_fill_in_middle(spark, sf_dir):
    """Form, cuts and digests of every document's fill-in-middle output."""
    from pyspark.sql import functions as F

    from .infill import fill_in_middle, restored
    out = restored(fill_in_middle(load(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2("text", 256).alias("restored_sha256"))


ORACLE_SQL["op11_fill_in_middle"] = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w,
             CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
c AS (SELECT *, CAST(len(w) AS BIGINT) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
             greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                       OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, text, n, form, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle,
             array_to_string(w[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


@query
def op12_window_packing(spark, sf_dir):
    """Place of every piece of every document in windows of 1024 tokens."""
    from .window_packing import pack_windows
    return pack_windows(load(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every anchor and positive."""
    from pyspark.sql import functions as F

    from .hard_negatives import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(load(spark, sf_dir, "embeddings").withColumn("label", label))


ORACLE_SQL["op13_hard_negatives"] = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.vec_id, b.label = a.label AS alike,
             CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM e a JOIN e b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) AS k FROM s WHERE alike)
      WHERE k <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
             s.score AS negative_score,
             row_number() OVER (PARTITION BY p.ar, p.k ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.ar = p.ar AND NOT s.alike
      AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""
