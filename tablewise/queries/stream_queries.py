"""Survey group G: streams. The SQL states what the stream has emitted once
all input is read: the windows the watermark has closed, and one row per
event id."""

import hashlib

from pyspark.sql import functions as F

from ..catalog import register
from ..sources.tables import events_stream, files_of
from ..streaming import events as st
from ..streaming import joins


def _name(spark, kind: str, sf_dir: str) -> str:
    """A stream belongs to a query, the folder it reads and the files there:
    a file rewritten under its name would be taken as read."""
    state = repr((sf_dir, files_of(spark, sf_dir, "events")))
    return f"{kind}-{hashlib.md5(state.encode()).hexdigest()[:16]}"


@register("stream_daily_counts", "P32", sql="""
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS events
FROM (SELECT date_trunc('day', ts) AS window_start FROM events) t
GROUP BY window_start
HAVING window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
""")
def q_stream_daily_counts(spark, sf_dir):
    """Streaming daily event counts, one-hour watermark, closed windows."""
    return st.run_to_parquet(spark, st.daily_counts(events_stream(spark, sf_dir)), _name(spark, "daily-counts", sf_dir))


@register("stream_dedupe", "P33", sql="""
SELECT event_id, min(ts) AS ts, min(user_id) AS user_id, min(event_type) AS event_type,
       min(value) AS value, min(props) AS props
FROM events GROUP BY event_id
""")
def q_stream_dedupe(spark, sf_dir):
    """Streaming removal of repeated event ids within a one-hour watermark."""
    return st.run_to_parquet(spark, st.dedupe_within_watermark(events_stream(spark, sf_dir)),
                             _name(spark, "dedupe", sf_dir))


@register("stream_view_before_purchase", "M02", sql="""
SELECT p.event_id AS purchase_id, p.user_id, p.ts AS purchase_ts, v.event_id AS view_id, v.ts AS view_ts
FROM events p JOIN events v ON p.user_id = v.user_id AND v.ts <= p.ts AND v.ts >= p.ts - INTERVAL 1 HOUR
WHERE p.event_type = 'purchase' AND v.event_type = 'view'
""")
def q_stream_view_before_purchase(spark, sf_dir):
    """Purchases beside the same user's views of the hour before, as a join
    of two streams."""
    of = lambda kind: events_stream(spark, sf_dir).where(F.col("event_type") == kind)
    out = joins.preceded_by(of("purchase"), of("view"))
    out = out.withColumnsRenamed({"later_id": "purchase_id", "later_ts": "purchase_ts", "earlier_id": "view_id",
                                  "earlier_ts": "view_ts"})
    return st.run_to_parquet(spark, out, _name(spark, "view-before-purchase", sf_dir))


@register("stream_closed_sessions", "M03", sql="""
WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
f AS (SELECT user_id, ts, CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS b FROM e),
s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events
FROM s GROUP BY user_id, sid
HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
""")
def q_stream_closed_sessions(spark, sf_dir):
    """Streaming user sessions with a 30-minute gap, closed ones only."""
    return st.run_to_parquet(spark, joins.closed_sessions(events_stream(spark, sf_dir)),
                             _name(spark, "closed-sessions", sf_dir), conf=joins.MERGE_FIRST)
