"""Frequent tokens and item sets."""

from pyspark.sql import functions as F

from ..catalog import register, tables
from ..functions.text import token_rows
from ..operators import frequent


@register("language_top_tokens", "M06", sql=r"""
WITH t AS (SELECT lang, unnest(string_split_regex(lower(text), '[ \t\r\n]')) AS token FROM documents),
c AS (SELECT lang, token, count(*) AS n FROM t WHERE token <> '' GROUP BY lang, token)
SELECT lang, token, n, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rank FROM c) WHERE rank <= 20
""")
def q_language_top_tokens(spark, sf_dir):
    """The 20 most frequent tokens of every language."""
    t = token_rows(tables(spark, sf_dir, "documents")["documents"], ["lang"], "text")
    return frequent.heavy_hitters(t, "lang", "token", 20)


@register("brand_sets", "M07", sql="""
WITH b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (SELECT CAST(ceil(0.001 * count(DISTINCT o)) AS BIGINT) AS least FROM b),
s AS (SELECT x.i || ',' || y.i AS items, 2 AS size, count(*) AS baskets FROM b x JOIN b y ON x.o = y.o AND x.i < y.i GROUP BY 1
      UNION ALL
      SELECT x.i || ',' || y.i || ',' || z.i, 3, count(*)
      FROM b x JOIN b y ON x.o = y.o AND x.i < y.i JOIN b z ON y.o = z.o AND y.i < z.i GROUP BY 1)
SELECT items, size, baskets FROM s, n WHERE baskets >= least
""")
def q_brand_sets(spark, sf_dir):
    """Pairs and triples of brands that at least one order in a thousand holds."""
    t = tables(spark, sf_dir, "lineitem", "part")
    rows = t["lineitem"].select("l_orderkey", "l_partkey").join(
        t["part"].select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    out = frequent.frequent_sets(frequent.baskets(rows, "l_orderkey", "p_brand"), 0.001)
    return out.select(F.array_join("items", ",").alias("items"), F.size("items").alias("size"), "baskets")
