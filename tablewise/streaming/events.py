"""Streaming counts and de-duplication with event-time watermarks.

Sources are file streams over the events folder; results go to a Parquet
file sink whose commit log (`_spark_metadata`) makes reads see only
committed micro-batches. Sink and checkpoint live under a stable name in the
shared folder of `spark.checkpoint.dir`, so a restarted query resumes from
its offsets and state instead of recomputing, and a lost executor only
replays its micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stream_home


def utc_instant(ts_ntz: Column) -> Column:
    """timestamp_ntz -> timestamp, reading the wall clock as UTC whatever
    the session zone (watermarks need a zoned timestamp)."""
    return F.to_timestamp(F.concat(ts_ntz.cast("string"), F.lit("Z")))


def instant_to_ntz(ts: Column) -> Column:
    """timestamp -> timestamp_ntz showing the UTC wall clock."""
    secs = (F.unix_micros(ts) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=secs)


def daily_counts(events: DataFrame, delay: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Tumbling event-time window counts per ``width``, finalised once the
    watermark (max event time - ``delay``) passes the window end. Output
    (append mode): window_start, window_end, events. Spark's guarantee:
    rows within ``delay`` are always counted; rows older than the watermark
    of the previous micro-batch are dropped (an emitted window never
    changes); a row arriving in the very batch where the watermark first
    passes it may still be counted if its window is still open."""
    ev = events.select(utc_instant(F.col("ts")).alias("event_time"))
    return (ev.withWatermark("event_time", delay)
            .groupBy(F.window("event_time", width).alias("w"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(instant_to_ntz(F.col("w.start")).alias("window_start"),
                    instant_to_ntz(F.col("w.end")).alias("window_end"), "events"))


def dedupe_within_watermark(events: DataFrame, key: str = "event_id", delay: str = "1 hour") -> DataFrame:
    """Drop repeats of ``key`` arriving while the first copy is within the
    watermark delay; state for a key expires after that, so state size is
    bounded by the keys seen in one delay span."""
    ev = events.withColumn("_event_time", utc_instant(F.col("ts")))
    return (ev.withWatermark("_event_time", delay)
            .dropDuplicatesWithinWatermark([key])
            .drop("_event_time"))


def run_to_parquet(spark: SparkSession, stream: DataFrame, name: str, mode: str = "append",
                   sink: str | None = None, checkpoint: str | None = None,
                   conf: dict[str, str] | None = None) -> DataFrame:
    """Run ``stream`` over all input available now (`availableNow`: every
    pending file, split into micro-batches, then stop) into a Parquet sink,
    and return the sink read as a batch DataFrame. Running the same ``name``
    again reads only files that are new since. ``conf`` holds for this stream
    only (a stream copies the session's settings when it starts)."""
    base = stream_home(spark, name)
    sink = sink or f"{base}/out"
    checkpoint = checkpoint or f"{base}/checkpoint"
    before = {k: spark.conf.get(k, None) for k in conf or {}}
    for k, v in (conf or {}).items():
        spark.conf.set(k, v)
    try:
        q = (stream.writeStream.format("parquet").outputMode(mode)
             .option("path", sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(sink)
