"""Streams against batch: closed windows equal batch counts, repeats are
removed, late rows beyond the watermark are dropped."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablewise.sources.tables import events_stream
from tablewise.streaming import events as st

from small import SF_SMALL


def write(folder, name, table, mtime):
    path = os.path.join(folder, name)
    pq.write_table(table, path)
    os.utime(path, (mtime, mtime))


def table_folder(tmp_path):
    folder = tmp_path / "events.parquet"
    folder.mkdir()
    return folder


def test_closed_daily_windows_equal_batch(spark):
    out = st.run_to_parquet(spark, st.daily_counts(events_stream(spark, SF_SMALL)), "t-daily")
    got = {r.window_start: r.events for r in out.collect()}
    batch = {r.day: r.n for r in spark.read.parquet(f"{SF_SMALL}/events.parquet")
             .groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    last_day = max(batch)
    assert last_day not in got  # still open: no later event moved the watermark past it
    assert got == {d: n for d, n in batch.items() if d != last_day}


def test_dedupe_removes_repeats(spark, tmp_path):
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    folder = table_folder(tmp_path)
    write(folder, "part-0.parquet", t, 1_000_000)
    write(folder, "part-1.parquet", t.slice(0, 100), 1_000_100)
    stream = events_stream(spark, str(tmp_path))
    out = st.run_to_parquet(spark, st.dedupe_within_watermark(stream), "t-dedupe")
    assert spark.read.parquet(str(folder)).count() == t.num_rows + 100
    assert out.count() == t.num_rows
    assert out.select("event_id").distinct().count() == t.num_rows


def test_late_rows_beyond_watermark_are_dropped(spark, tmp_path):
    schema = pq.read_table(f"{SF_SMALL}/events.parquet").schema

    def rows(items):
        cols = {f.name: [] for f in schema}
        for i, ts in items:
            for k, v in zip(cols, [i, ts, 1, "view", 1.0, "{}"]):
                cols[k].append(v)
        return pa.table(cols, schema=schema)

    d0 = dt.datetime(2024, 1, 1, 12)
    # One file per micro-batch. Spark filters late rows with the previous
    # batch's watermark, so the late row comes two batches after the
    # watermark moved past its window.
    folder = table_folder(tmp_path)
    write(folder, "part-1.parquet", rows([(1, d0), (2, d0 + dt.timedelta(days=3))]), 1_000_000)
    write(folder, "part-2.parquet", rows([(4, d0 + dt.timedelta(days=3, hours=1))]), 1_000_100)
    write(folder, "part-3.parquet", rows([(3, d0 + dt.timedelta(hours=1))]), 1_000_200)
    write(folder, "part-4.parquet", rows([(5, d0 + dt.timedelta(days=9))]), 1_000_300)
    stream = events_stream(spark, str(tmp_path), max_files_per_trigger=1)
    out = st.run_to_parquet(spark, st.daily_counts(stream), "t-late")
    got = {r.window_start.day: r.events for r in out.collect()}
    assert got == {1: 1, 4: 2}


def test_folder_of_part_files_equals_one_file(spark, tmp_path):
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    folder = table_folder(tmp_path)
    for k in range(3):
        write(folder, f"part-{k}.parquet", t.slice(k * 400, 400), 1_000_000 + k)
    (tmp_path / "events.parquet.old").mkdir()  # a neighbour with a longer name is not the table
    write(tmp_path / "events.parquet.old", "part-0.parquet", t, 1_000_000)
    one = st.run_to_parquet(spark, st.daily_counts(events_stream(spark, SF_SMALL)), "t-one")
    many = st.run_to_parquet(spark, st.daily_counts(events_stream(spark, str(tmp_path))), "t-many")
    assert many.count() > 0 and sorted(many.collect()) == sorted(one.collect())
    assert st.run_to_parquet(spark, st.dedupe_within_watermark(events_stream(spark, str(tmp_path))),
                             "t-many-ids").count() == t.num_rows


def test_empty_listing_fails(spark, tmp_path):
    table_folder(tmp_path)
    with pytest.raises(Exception):
        events_stream(spark, str(tmp_path))


def test_restart_resumes_without_repeats(spark, tmp_path):
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    folder = table_folder(tmp_path)
    write(folder, "part-0.parquet", t.slice(0, 600), 1_000_000)

    def run():
        return st.run_to_parquet(spark, st.dedupe_within_watermark(events_stream(spark, str(tmp_path))), "t-resume")
    assert run().count() == 600
    write(folder, "part-1.parquet", t.slice(600), 1_000_100)
    assert run().count() == t.num_rows
    assert run().count() == t.num_rows


def test_query_reads_a_file_rewritten_under_its_name(spark, tmp_path):
    from tablewise.queries.stream_queries import q_stream_dedupe
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    for part in (t.slice(0, 300), t.slice(300, 400)):
        pq.write_table(part, tmp_path / "events.parquet")
        for _ in range(2):
            got = {r["event_id"] for r in q_stream_dedupe(spark, str(tmp_path)).select("event_id").collect()}
            assert got == set(part["event_id"].to_pylist())
