"""Joins of two streams within a time bound, and sessions of a stream."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .events import instant_to_ntz, utc_instant

#: For `run_to_parquet(conf=...)`: rows of one user are merged into sessions
#: before they are shuffled, so a hot user sends sessions and not events.
MERGE_FIRST = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def preceded_by(later: DataFrame, earlier: DataFrame, within: timedelta = timedelta(hours=1), delay: str = "1 hour",
                key: str = "user_id", id_col: str = "event_id", ts: str = "ts", how: str = "inner") -> DataFrame:
    """Rows of the stream ``later`` beside the rows of the stream ``earlier``
    of the same ``key`` that come at most ``within`` before them (or at the
    same time): later_id, key, later_ts, earlier_id, earlier_ts. With
    ``how="left_outer"`` a row without such a partner comes once with nulls,
    when the watermark shows that none can follow.

    Both streams have a watermark of ``delay``, and the time bound lets Spark
    drop state: an earlier row after ``within``, a later row once the earlier
    stream has passed it. Both sides are also keyed by time bins of
    ``within``, each earlier row in its own bin and the next: a pair meets in
    the later row's bin only, and a key with very many rows is spread over
    many state partitions.

    Defined cases: null keys and null times join nothing (a later row without
    a time is left out, one without a key is unmatched); repeated rows are
    joined each; rows behind the watermark of an earlier micro-batch are
    dropped.
    """
    span = int(within.total_seconds() * 1_000_000)

    def timed(stream: DataFrame, name: str) -> DataFrame:
        at = utc_instant(F.col(ts))
        return (stream.select(F.col(id_col).alias(f"{name}_id"), F.col(key).alias(f"{name}_key"), at.alias(f"{name}_time"))
                .withWatermark(f"{name}_time", delay).where(F.col(f"{name}_time").isNotNull()))
    bin_ = lambda c: F.floor(F.unix_micros(c) / F.lit(span)).cast("long")
    x = timed(later, "later").withColumn("later_bin", bin_("later_time"))
    y = timed(earlier, "earlier").withColumn(
        "earlier_bin", F.explode(F.array(bin_("earlier_time"), bin_("earlier_time") + 1)))
    bound = F.make_dt_interval(secs=F.lit(span / 1_000_000).cast("decimal(18,6)"))
    joined = x.join(y, (F.col("later_key") == F.col("earlier_key")) & (F.col("later_bin") == F.col("earlier_bin"))
                    & (F.col("earlier_time") <= F.col("later_time"))
                    & (F.col("earlier_time") >= F.col("later_time") - bound), how)
    return joined.select("later_id", F.col("later_key").alias(key), instant_to_ntz(F.col("later_time")).alias("later_ts"),
                         "earlier_id", instant_to_ntz(F.col("earlier_time")).alias("earlier_ts"))


def closed_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour", user: str = "user_id",
                    ts: str = "ts") -> DataFrame:
    """Sessions of a stream, each emitted once when the watermark (max event
    time - ``delay``) has passed its end: user, session_start, session_end
    (last event + ``gap``), events. The state per user is its open sessions;
    an event between two of them merges them.

    Defined cases: a null user is a user like any other; events without a
    time are not counted; repeated rows count each; an event behind the
    watermark of an earlier micro-batch is dropped, so a session that was
    emitted never changes.
    """
    ev = events.select(F.col(user), utc_instant(F.col(ts)).alias("event_time")).where(F.col("event_time").isNotNull())
    return (ev.withWatermark("event_time", delay).groupBy(user, F.session_window("event_time", gap).alias("w"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(user, instant_to_ntz(F.col("w.start")).alias("session_start"),
                    instant_to_ntz(F.col("w.end")).alias("session_end"), "events"))
