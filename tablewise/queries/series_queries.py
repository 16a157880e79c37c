"""Change points and bootstrap intervals of the events."""

from ..catalog import register, tables
from ..operators import resample, series


@register("event_change_points", "M10", sql="""
WITH RECURSIVE d AS (SELECT event_type, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS u, count(*) AS n
                     FROM events WHERE ts IS NOT NULL GROUP BY ALL),
span AS (SELECT event_type, min(u) AS lo, max(u) AS hi FROM d GROUP BY event_type),
x AS (SELECT s.event_type, s.lo, s.hi, v.u, coalesce(d.n, 0) AS n
      FROM span s, unnest(range(s.lo, s.hi + 1)) AS v(u)
      LEFT JOIN d ON d.event_type IS NOT DISTINCT FROM s.event_type AND d.u = v.u),
c AS (SELECT event_type, lo, u, CAST(sum(n) OVER w AS BIGINT) AS s, CAST(sum(n * n) OVER w AS BIGINT) AS q FROM x
      WINDOW w AS (PARTITION BY event_type ORDER BY u)),
p AS (SELECT event_type, lo, count(*) AS n, list_prepend(0, list(s ORDER BY u)) AS s, list_prepend(0, list(q ORDER BY u)) AS q
      FROM c GROUP BY event_type, lo),
b AS (SELECT *, ((q[n + 1] - s[n + 1] * s[n + 1] / n) / n) * ln(n) AS pen FROM p),
f AS (SELECT event_type, lo, n, s, q, pen, CAST(0 AS BIGINT) AS t, [-pen] AS best, [CAST(0 AS BIGINT)] AS start FROM b
      UNION ALL
      SELECT event_type, lo, n, s, q, pen, t + 1, list_append(best, list_min(cost) + pen),
             list_append(start, CAST(CASE WHEN pen > 0 THEN list_position(cost, list_min(cost)) - 1 ELSE 0 END AS BIGINT))
      FROM (SELECT *, list_transform(range(0, t + 1), lambda j: best[j + 1] + ((q[t + 2] - q[j + 1])
                                     - (s[t + 2] - s[j + 1]) * (s[t + 2] - s[j + 1]) / (t + 1 - j))) AS cost
            FROM f WHERE t < n)),
z AS (SELECT event_type, lo, s, start, n AS b, start[n + 1] AS a FROM f WHERE t = n
      UNION ALL SELECT event_type, lo, s, start, a, start[a + 1] FROM z WHERE a > 0)
SELECT event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY a) AS INTEGER) AS segment,
       CAST(DATE '1970-01-01' + CAST(lo + a AS INTEGER) AS TIMESTAMP) AS first,
       CAST(DATE '1970-01-01' + CAST(lo + b - 1 AS INTEGER) AS TIMESTAMP) AS last, b - a AS units,
       floor((s[b + 1] - s[a + 1])::DOUBLE / (b - a) * 1e6 + 0.5) / 1e6 AS mean
FROM z
""")
def q_event_change_points(spark, sf_dir):
    """Segments of steady daily counts per event type."""
    return series.count_change_points(tables(spark, sf_dir, "events")["events"], "event_type", "ts")


def _draw_sql(key: str, r: str) -> str:
    """SQL text of `resample.draw` for keys that are not negative."""
    x = f"(({key} % {resample.PRIME}) * {resample.ROUNDS[0]} + {r} * 40692 + ({key} // {resample.PRIME})) % {resample.PRIME}"
    steps = [f"SELECT *, {x} AS x FROM e"]
    for k, m in enumerate(resample.ROUNDS):
        steps.append(f"SELECT * REPLACE ((x * x + {r} * {69_621 + k} + {m}) % {resample.PRIME} AS x) FROM ({steps[-1]})")
        steps.append(f"SELECT * REPLACE ((x * {m} + {key} % {resample.PRIME}) % {resample.PRIME} AS x) FROM ({steps[-1]})")
    return steps[-1]


@register("event_value_intervals", "M11", sql=f"""
WITH v AS (SELECT event_type, user_id AS k, sum(floor(value)::BIGINT)::BIGINT AS a,
                  sum(floor((value - floor(value)) * 1000000 + 0.5)::BIGINT)::BIGINT AS b, count(*) AS n
           FROM events WHERE isfinite(value) AND user_id IS NOT NULL GROUP BY ALL),
e AS (SELECT v.*, r FROM v, range(0, 201) AS t(r)),
h AS ({_draw_sql('k', 'r')}),
w AS (SELECT *, CASE WHEN r = 0 THEN 1 ELSE {' + '.join(f'(x >= {t})::BIGINT' for t in resample.poisson_bounds())} END AS w FROM h),
m AS (SELECT event_type, r, sum(w * n)::BIGINT AS n, (sum(w * a)::BIGINT + sum(w * b)::BIGINT / 1000000.0) / sum(w * n)::BIGINT AS m
      FROM w WHERE w > 0 GROUP BY event_type, r),
l AS (SELECT event_type, max(n) FILTER (WHERE r = 0) AS n, max(m) FILTER (WHERE r = 0) AS mean,
             list_sort(list(m) FILTER (WHERE r > 0)) AS ms FROM m GROUP BY event_type),
s AS (SELECT *, coalesce(len(ms), 0) AS z FROM l)
SELECT event_type, n, floor(mean * 1e6 + 0.5) / 1e6 AS mean,
       floor(ms[CAST(floor((z - 1) * {(1 - 0.95) / 2!r}::DOUBLE + 0.5) AS INTEGER) + 1] * 1e6 + 0.5) / 1e6 AS low,
       floor(ms[CAST(floor((z - 1) * {1 - (1 - 0.95) / 2!r}::DOUBLE + 0.5) AS INTEGER) + 1] * 1e6 + 0.5) / 1e6 AS high,
       CAST(z AS INTEGER) AS replicates
FROM s
""")
def q_event_value_intervals(spark, sf_dir):
    """Mean event value per type with its 95 % interval, users drawn."""
    return resample.bootstrap_means(tables(spark, sf_dir, "events")["events"], "event_type", "value", "user_id")
