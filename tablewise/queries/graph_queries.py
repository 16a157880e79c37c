"""Triangles of the trade graph."""

from pyspark.sql import functions as F

from ..catalog import register, tables
from ..operators import graph
from ..plans.lineage import materialize

KINDS = ("customer", "part", "supplier")


@register("trade_triangles", "M08", sql="""
WITH l AS (SELECT o_custkey AS c, l_partkey AS p, l_suppkey AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
cp AS (SELECT DISTINCT c, p FROM l), cs AS (SELECT DISTINCT c, s FROM l), ps AS (SELECT DISTINCT p, s FROM l),
d AS (SELECT kind, key, count(*) AS degree FROM (
        SELECT 'customer' AS kind, c AS key FROM cp UNION ALL SELECT 'customer', c FROM cs
        UNION ALL SELECT 'part', p FROM cp UNION ALL SELECT 'part', p FROM ps
        UNION ALL SELECT 'supplier', s FROM cs UNION ALL SELECT 'supplier', s FROM ps) GROUP BY kind, key),
t AS (SELECT c, p, s FROM cp JOIN ps USING (p) JOIN cs USING (c, s)),
n AS (SELECT 'customer' AS kind, c AS key, count(*) AS n FROM t GROUP BY c
      UNION ALL SELECT 'part', p, count(*) FROM t GROUP BY p UNION ALL SELECT 'supplier', s, count(*) FROM t GROUP BY s)
SELECT kind, key, degree, coalesce(n, 0) AS triangles,
       floor(2.0 * coalesce(n, 0)::DOUBLE / nullif(degree::DOUBLE * (degree - 1), 0) * 1e6 + 0.5) / 1e6 AS clustering
FROM d LEFT JOIN n USING (kind, key)
""")
def q_trade_triangles(spark, sf_dir):
    """Triangles and clustering in the graph of customers, parts and
    suppliers that meet in an order line."""
    t = tables(spark, sf_dir, "lineitem", "orders")
    rows = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey").join(
        t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    node = [(F.col(c).cast("long") * 3 + k).alias(c) for k, c in enumerate(("o_custkey", "l_partkey", "l_suppkey"))]
    rows = materialize(rows.select(*node))
    pair = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    edges = rows.select(F.explode(F.array(pair("o_custkey", "l_partkey"), pair("o_custkey", "l_suppkey"),
                                          pair("l_partkey", "l_suppkey"))).alias("e"))
    # Parts have the fewest links as a rule, suppliers the most.
    found = graph.triangles(edges.select("e.a", "e.b"), "a", "b",
                            kind=lambda n: F.element_at(F.array(*map(F.lit, (1, 0, 2))), (F.pmod(n, F.lit(3)) + 1).cast("int")))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("node") % 3 + 1).cast("int"))
    return found.select(kind.alias("kind"), F.floor(F.col("node") / 3).alias("key"), "degree", "triangles", "clustering")
