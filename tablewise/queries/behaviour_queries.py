"""Survey group D: time and behaviour."""

from ..catalog import register, tables
from ..operators import behaviour

# Fixed value: the origin from which cohort weeks are counted.
RETENTION_ORIGIN = "2024-01-01"


@register("customer_moving_average", "P17", sql="""
SELECT o_custkey, o_orderdate, o_orderkey,
       floor(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                     ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) * 1e4 + 0.5) / 1e4
         AS moving_avg
FROM orders
""")
def q_customer_moving_average(spark, sf_dir):
    """Seven-order moving average of order value per customer."""
    return behaviour.moving_average(tables(spark, sf_dir, "orders")["orders"], "o_custkey",
                                    ["o_orderdate", "o_orderkey"], "o_totalprice", rows=7)


@register("hourly_event_counts", "P18", sql="""
WITH c AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1),
h AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM c)
SELECT h.hour, coalesce(c.n, 0) AS n FROM h LEFT JOIN c ON h.hour = c.hour
""")
def q_hourly_event_counts(spark, sf_dir):
    """Events per hour with empty hours present."""
    return behaviour.hourly_counts(tables(spark, sf_dir, "events")["events"])


@register("user_sessions", "P19", sql="""
WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
f AS (SELECT user_id, ts,
             CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS b FROM e),
s AS (SELECT user_id, ts,
             sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
       count(*) AS events
FROM s GROUP BY user_id, sid
""")
def q_user_sessions(spark, sf_dir):
    """Sessions per user with a 30-minute inactivity gap."""
    return behaviour.sessions(tables(spark, sf_dir, "events")["events"])


@register("purchase_last_view", "P20", sql="""
SELECT p.event_id, p.user_id, p.ts, v.event_id AS match_id, v.ts AS match_ts
FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND p.ts > v.ts
""")
def q_purchase_last_view(spark, sf_dir):
    """For each purchase, the same user's latest earlier view (as-of)."""
    return behaviour.latest_before(tables(spark, sf_dir, "events")["events"], "purchase", "view")


@register("signup_funnel", "P21", sql="""
WITH s AS (SELECT user_id, min(ts) AS t0 FROM events WHERE event_type = 'signup' GROUP BY user_id),
v AS (SELECT s.user_id, s.t0, min(e.ts) AS t1
      FROM s JOIN events e ON e.user_id = s.user_id AND e.event_type = 'view'
                          AND e.ts > s.t0 AND e.ts <= s.t0 + INTERVAL 1 DAY
      GROUP BY s.user_id, s.t0),
p AS (SELECT v.user_id, min(e.ts) AS t2
      FROM v JOIN events e ON e.user_id = v.user_id AND e.event_type = 'purchase'
                          AND e.ts > v.t1 AND e.ts <= v.t0 + INTERVAL 1 DAY
      GROUP BY v.user_id)
SELECT 'signup' AS step, 1 AS step_no, count(*) AS users FROM s
UNION ALL SELECT 'view', 2, count(*) FROM v
UNION ALL SELECT 'purchase', 3, count(*) FROM p
""")
def q_signup_funnel(spark, sf_dir):
    """Users going signup -> view -> purchase within a day of signing up."""
    return behaviour.funnel(tables(spark, sf_dir, "events")["events"], ["signup", "view", "purchase"])


@register("weekly_retention", "P22", sql=f"""
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
f AS (SELECT user_id, min(day) AS first_day FROM d GROUP BY user_id)
SELECT CAST(floor(datediff('day', DATE '{RETENTION_ORIGIN}', f.first_day) / 7) AS INTEGER) AS cohort_week,
       CAST(floor(datediff('day', f.first_day, d.day) / 7) AS INTEGER) AS weeks_since,
       count(DISTINCT d.user_id) AS users
FROM d JOIN f ON d.user_id = f.user_id
GROUP BY 1, 2
""")
def q_weekly_retention(spark, sf_dir):
    """Distinct active users by first-seen week and weeks since first seen."""
    return behaviour.weekly_retention(tables(spark, sf_dir, "events")["events"], RETENTION_ORIGIN)


@register("customer_rfm", "P23", sql="""
WITH c AS (
  SELECT o_custkey, datediff('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS recency_days,
         count(*) AS frequency, CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) AS DOUBLE) AS m
  FROM orders GROUP BY o_custkey),
q AS (SELECT quantile_cont(recency_days, [0.25, 0.5, 0.75]) AS rq,
             quantile_cont(frequency, [0.25, 0.5, 0.75]) AS fq,
             quantile_cont(m, [0.25, 0.5, 0.75]) AS mq FROM c)
SELECT o_custkey, CAST(recency_days AS INTEGER) AS recency_days, frequency,
       floor(m * 1e2 + 0.5) / 1e2 AS monetary,
       CAST(5 - CASE WHEN recency_days <= rq[1] THEN 1 WHEN recency_days <= rq[2] THEN 2
                     WHEN recency_days <= rq[3] THEN 3 ELSE 4 END AS INTEGER) AS r_score,
       CAST(CASE WHEN frequency <= fq[1] THEN 1 WHEN frequency <= fq[2] THEN 2
                 WHEN frequency <= fq[3] THEN 3 ELSE 4 END AS INTEGER) AS f_score,
       CAST(CASE WHEN m <= mq[1] THEN 1 WHEN m <= mq[2] THEN 2
                 WHEN m <= mq[3] THEN 3 ELSE 4 END AS INTEGER) AS m_score
FROM c CROSS JOIN q
""")
def q_customer_rfm(spark, sf_dir):
    """Recency, frequency and value per customer with quartile scores."""
    return behaviour.rfm_scores(tables(spark, sf_dir, "orders")["orders"])
