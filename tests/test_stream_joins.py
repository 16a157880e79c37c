"""Joins of two streams and streaming sessions: against batch, late rows,
restarts."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq

from tablewise.operators import behaviour
from tablewise.sources.tables import events_stream
from tablewise.streaming import events as st
from tablewise.streaming import joins

from small import SF_SMALL

D0 = dt.datetime(2024, 1, 1, 12)
MIN, HOUR, DAY = dt.timedelta(minutes=1), dt.timedelta(hours=1), dt.timedelta(days=1)


def write(folder, part, rows):
    """One file per micro-batch: rows (event_id, ts, user_id, event_type)."""
    schema = pq.read_table(f"{SF_SMALL}/events.parquet").schema
    folder = folder / "events.parquet"
    folder.mkdir(exist_ok=True)
    full = [(*r, 1.0, "{}") for r in rows]
    table = pa.table({f.name: pa.array([r[k] for r in full], f.type) for k, f in enumerate(schema)}, schema=schema)
    path = os.path.join(folder, f"part-{part}.parquet")
    pq.write_table(table, path)
    os.utime(path, (1_000_000 + 100 * part,) * 2)


def purchases(spark, folder, name, how="inner"):
    def of(kind):
        return events_stream(spark, str(folder), max_files_per_trigger=1).where(f"event_type = '{kind}'")
    out = st.run_to_parquet(spark, joins.preceded_by(of("purchase"), of("view"), how=how), name)
    return sorted(((r["later_id"], r["earlier_id"]) for r in out.collect()), key=str)


def test_pairs_within_the_bound(spark, tmp_path):
    write(tmp_path, 0, [(1, D0, 7, "view"), (2, D0 + HOUR, 7, "purchase"), (3, D0 + HOUR + MIN / 60, 7, "purchase"),
                        (4, D0 + 2 * HOUR, 7, "view"), (5, D0 + 2 * HOUR, 7, "purchase"), (6, D0 + 2 * HOUR, 8, "purchase"),
                        (7, D0, None, "view"), (8, D0, None, "purchase"), (9, None, 7, "view"), (10, None, 7, "purchase"),
                        (11, D0 + HOUR / 2, 7, "view"), (11, D0 + HOUR / 2, 7, "view")])
    want = [(2, 1), (2, 11), (2, 11), (3, 11), (3, 11), (5, 4)]
    assert purchases(spark, tmp_path, "t-pairs") == want


def test_rows_of_different_micro_batches_join_and_late_ones_are_dropped(spark, tmp_path):
    write(tmp_path, 0, [(1, D0, 7, "view"), (20, D0, 9, "purchase")])
    write(tmp_path, 1, [(2, D0 + HOUR / 2, 7, "purchase"), (21, D0 + HOUR / 2, 9, "view")])
    write(tmp_path, 2, [(3, D0 + 3 * DAY, 7, "view"), (22, D0 + 3 * DAY, 9, "purchase")])
    write(tmp_path, 3, [(4, D0 + 3 * DAY + MIN, 7, "view"), (23, D0 + 3 * DAY + MIN, 9, "purchase")])
    # Both streams are past this time by three days: the purchase is late.
    write(tmp_path, 4, [(5, D0 + HOUR / 2, 7, "purchase"), (24, D0 + 3 * DAY + 2 * MIN, 7, "view")])
    assert purchases(spark, tmp_path, "t-late-join") == [(2, 1)]


def test_join_goes_on_after_a_restart(spark, tmp_path):
    write(tmp_path, 0, [(1, D0, 7, "view")])
    assert purchases(spark, tmp_path, "t-join-restart") == []
    write(tmp_path, 1, [(2, D0 + HOUR / 2, 7, "purchase")])
    assert purchases(spark, tmp_path, "t-join-restart") == [(2, 1)]  # the view is in the state
    assert purchases(spark, tmp_path, "t-join-restart") == [(2, 1)]


def test_outer_join_tells_of_rows_without_a_partner(spark, tmp_path):
    write(tmp_path, 0, [(1, D0, 7, "view"), (2, D0 + MIN, 7, "purchase"), (3, D0 + MIN, 8, "purchase")])
    write(tmp_path, 1, [(4, D0 + DAY, 7, "view"), (5, D0 + DAY, 9, "purchase")])
    write(tmp_path, 2, [(6, D0 + DAY + MIN, 7, "view"), (7, D0 + DAY + MIN, 9, "purchase")])
    got = purchases(spark, tmp_path, "t-outer", "left_outer")
    assert got == [(2, 1), (3, None)]  # the last purchases may still find a view


def sessions(spark, folder, name, files=1):
    stream = events_stream(spark, str(folder), max_files_per_trigger=files)
    out = st.run_to_parquet(spark, joins.closed_sessions(stream), name, conf=joins.MERGE_FIRST)
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_closed_sessions_equal_the_batch_answer(spark):
    got = sessions(spark, SF_SMALL, "t-sessions")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    closed = events.agg({"ts": "max"}).first()[0] - HOUR
    batch = [tuple(r) for r in behaviour.sessions(events).collect()]
    assert got == sorted((r for r in batch if r[2] <= closed), key=str) and 0 < len(got) < len(batch)


def test_sessions_merge_over_micro_batches_and_restarts(spark, tmp_path):
    write(tmp_path, 0, [(1, D0, 7, "view"), (2, D0 + 50 * MIN, 7, "view"), (3, D0, None, "view"), (4, None, 7, "view")])
    assert sessions(spark, tmp_path, "t-sessions-restart") == []
    # Joins the two open sessions of user 7; then the watermark passes all.
    write(tmp_path, 1, [(5, D0 + 25 * MIN, 7, "view")])
    write(tmp_path, 2, [(6, D0 + DAY, 8, "view")])
    write(tmp_path, 3, [(7, D0 + DAY + MIN, 8, "view")])
    want = [(7, D0, D0 + 80 * MIN, 3), (None, D0, D0 + 30 * MIN, 1)]
    assert sessions(spark, tmp_path, "t-sessions-restart") == want
    # Late: more than an hour behind what earlier micro-batches had seen.
    write(tmp_path, 4, [(8, D0 + 10 * MIN, 7, "view")])
    write(tmp_path, 5, [(9, D0 + 3 * DAY, 7, "view")])
    want = sorted([*want, (8, D0 + DAY, D0 + DAY + 31 * MIN, 2)], key=str)
    assert sessions(spark, tmp_path, "t-sessions-restart") == want


def test_settings_of_a_stream_are_put_back(spark, tmp_path):
    key = next(iter(joins.MERGE_FIRST))
    before = spark.conf.get(key)
    write(tmp_path, 0, [(1, D0, 7, "view")])
    sessions(spark, tmp_path, "t-conf")
    assert spark.conf.get(key) == before
