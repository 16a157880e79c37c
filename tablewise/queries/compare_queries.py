"""Comparison of two versions of a table."""

from pyspark.sql import functions as F

from ..catalog import register, tables
from ..operators import compare


@register("customer_order_changes", "M12", sql="""
WITH bounds AS (SELECT max(year(o_orderdate)) AS y FROM orders),
c AS (SELECT o_custkey, o_orderstatus, o_orderpriority,
             count(*) FILTER (WHERE year(o_orderdate) = y - 1) AS o, count(*) FILTER (WHERE year(o_orderdate) = y) AS n
      FROM orders, bounds WHERE year(o_orderdate) >= y - 1 GROUP BY ALL),
k AS (SELECT o_custkey, sum(o) AS rows_old, sum(n) AS rows_new, sum(greatest(n - o, 0)) AS rows_added,
             sum(greatest(o - n, 0)) AS rows_removed, sum(greatest(o - 1, 0)) AS duplicates_old,
             sum(greatest(n - 1, 0)) AS duplicates_new FROM c GROUP BY o_custkey)
SELECT o_custkey, CASE WHEN rows_old = 0 THEN 'added' WHEN rows_new = 0 THEN 'removed'
                       WHEN rows_added + rows_removed > 0 THEN 'changed' ELSE 'unchanged' END AS status,
       CAST(rows_old AS BIGINT) AS rows_old, CAST(rows_new AS BIGINT) AS rows_new,
       CAST(rows_added AS BIGINT) AS rows_added, CAST(rows_removed AS BIGINT) AS rows_removed,
       CAST(duplicates_old AS BIGINT) AS duplicates_old, CAST(duplicates_new AS BIGINT) AS duplicates_new
FROM k
""")
def q_customer_order_changes(spark, sf_dir):
    """How every customer's orders (status and priority) of the last year
    differ from those of the year before."""
    orders = tables(spark, sf_dir, "orders")["orders"].select(
        "o_custkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("y"))
    last = orders.agg(F.max("y").alias("y")).first()["y"]
    of = lambda y: orders.where(F.col("y") == F.lit(y).cast("int"))
    return compare.keyed_difference(of(last - 1 if last else None), of(last), ["o_custkey"],
                                    ["o_orderstatus", "o_orderpriority"], unchanged=True)
