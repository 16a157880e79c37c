"""Survey group A: joins, anti join, rollup, top-k."""

from ..catalog import register, tables
from ..operators import base


@register("nation_revenue", "P01", sql="""
SELECT n_name,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
       CAST(count(*) AS BIGINT) AS line_count
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name
""")
def q_nation_revenue(spark, sf_dir):
    """Revenue and line count per customer nation."""
    t = tables(spark, sf_dir, "lineitem", "orders", "customer", "nation")
    return base.nation_revenue(t["lineitem"], t["orders"], t["customer"], t["nation"])


@register("orders_without_lines", "P02", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def q_orders_without_lines(spark, sf_dir):
    """Orders with no line item (anti join)."""
    t = tables(spark, sf_dir, "orders", "lineitem")
    return base.orders_without_lines(t["orders"], t["lineitem"])


@register("customers_by_region", "P03", sql="""
SELECT r_name, n_name,
       CAST(count(*) AS BIGINT) AS customers,
       CAST(GROUPING(r_name, n_name) AS INTEGER) AS level
FROM customer
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)
""")
def q_customers_by_region(spark, sf_dir):
    """Customer counts by region and nation with subtotals."""
    t = tables(spark, sf_dir, "customer", "nation", "region")
    return base.customers_by_region(t["customer"], t["nation"], t["region"])


@register("top_orders_per_customer", "P04", sql="""
SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         CAST(row_number() OVER (PARTITION BY o_custkey
                                 ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
  FROM orders) t
WHERE rank <= 3
""")
def q_top_orders_per_customer(spark, sf_dir):
    """Three largest orders per customer, ties by order key."""
    return base.top_orders_per_customer(tables(spark, sf_dir, "orders")["orders"], 3)
