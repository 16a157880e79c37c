"""Operators on hand-made rows: nulls, ties, zero divisors, hot keys, late
and repeated events -- cases the driver tables do not contain."""

import contextlib
import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewise.operators import behaviour, clean, evaluate, explore

T0 = dt.datetime(2024, 1, 1)


@contextlib.contextmanager
def full_slices(spark):
    """Keep every range partition: on a few hundred rows adaptive execution
    would merge them all into one, as it would not for full-size data, and
    nothing would cross a slice boundary."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def ev(spark, rows):
    return spark.createDataFrame(
        pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type"]).astype(
            {"event_id": "int64", "user_id": "int64"}))


def test_profile_counts_nulls_and_skips_non_numeric_stats(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (None, "a", None), (3, None, 4.0)], "x int, s string, y double")
    got = {r.column_name: r for r in explore.profile(df).collect()}
    assert got["x"].nulls == 1 and got["x"].distinct_values == 2 and got["x"].mean == 2.0
    assert got["s"].nulls == 1 and got["s"].min_value is None
    assert got["y"].stddev == pytest.approx(np.std([2.0, 4.0], ddof=1), abs=1e-6)


def test_safe_division_and_target_encoding_single_fold(spark):
    # one language with all rows in one fold: the other folds are empty -> null, not an error
    rows = spark.createDataFrame([(5, "xx", 1), (10, "xx", 0)], "doc_id long, lang string, quality int")
    got = clean.out_of_fold_target_mean(rows, "doc_id", "lang", "quality").collect()
    assert [r.target_mean for r in got] == [None, None]


def test_moving_average_hot_key_matches_pandas(spark):
    rng = np.random.default_rng(3)
    n = 2000
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.4, 7, rng.integers(0, 20, n)).astype("int64"),
                        "d": rng.integers(0, 300, n).astype("int64"),
                        "id": np.arange(n, dtype="int64"), "v": rng.normal(50, 10, n)})
    with full_slices(spark):
        got = behaviour.moving_average(spark.createDataFrame(pdf), "k", ["d", "id"], "v", rows=7, digits=6)
        got = got.toPandas().set_index("id").moving_avg
    exp = (pdf.sort_values(["k", "d", "id"]).groupby("k").v
           .transform(lambda s: s.rolling(7, min_periods=1).mean()))
    assert np.allclose(got.loc[exp.index].values, exp.values, atol=1e-5)


def brute_sessions(pdf, gap):
    out = []
    for u, part in pdf.sort_values("ts").groupby("user_id"):
        start = prev = None
        n = 0
        for t in part.ts:
            if prev is None or t - prev >= gap:
                if start is not None:
                    out.append((u, start, prev + gap, n))
                start, n = t, 0
            prev = t
            n += 1
        out.append((u, start, prev + gap, n))
    return sorted(out)


def test_sessions_across_slices_match_brute_force(spark):
    rng = np.random.default_rng(5)
    ts = T0 + pd.to_timedelta(np.sort(rng.choice(3 * 24 * 3600, 800, replace=False)), unit="s")
    users = np.where(rng.random(800) < 0.5, 1, rng.integers(2, 6, 800))
    rows = [(i, t.to_pydatetime(), int(u), "view") for i, (t, u) in enumerate(zip(ts, users))]
    # exactly-at-gap and just-under-gap neighbours
    rows += [(9001, T0 + dt.timedelta(days=5), 99, "view"),
             (9002, T0 + dt.timedelta(days=5, minutes=30), 99, "view"),
             (9003, T0 + dt.timedelta(days=5, minutes=59, seconds=59), 99, "view")]
    df = ev(spark, rows)
    with full_slices(spark):
        got = sorted((r.user_id, r.session_start, r.session_end, r.events)
                     for r in behaviour.sessions(df).collect())
    exp = brute_sessions(df.toPandas(), pd.Timedelta(minutes=30))
    assert [(u, s.to_pydatetime(), e.to_pydatetime(), n) for u, s, e, n in exp] == got


def test_latest_before_carries_across_gaps(spark):
    rows = [(1, T0, 1, "view"),
            (2, T0 + dt.timedelta(hours=5), 1, "purchase"),       # view 5 buckets earlier
            (3, T0 + dt.timedelta(hours=5, minutes=1), 2, "purchase"),  # no view at all
            (4, T0 + dt.timedelta(hours=6), 1, "view"),
            (5, T0 + dt.timedelta(hours=6, seconds=1), 1, "purchase")]
    with full_slices(spark):
        got = {r.event_id: r.match_id
               for r in behaviour.latest_before(ev(spark, rows), "purchase", "view").collect()}
    assert got == {2: 1, 3: None, 5: 4}


def test_funnel_requires_order_and_window(spark):
    rows = [(1, T0, 1, "signup"), (2, T0 + dt.timedelta(hours=1), 1, "view"),
            (3, T0 + dt.timedelta(hours=2), 1, "purchase"),
            (4, T0, 2, "signup"), (5, T0 + dt.timedelta(hours=2), 2, "purchase"),   # purchase before view
            (6, T0 + dt.timedelta(hours=3), 2, "view"),
            (7, T0, 3, "signup"), (8, T0 + dt.timedelta(hours=1), 3, "view"),
            (9, T0 + dt.timedelta(days=2), 3, "purchase")]                           # too late
    got = {r.step: r.users for r in behaviour.funnel(ev(spark, rows), ["signup", "view", "purchase"]).collect()}
    assert got == {"signup": 3, "view": 3, "purchase": 1}


def test_funnel_empty_steps_report_zero(spark):
    rows = [(1, T0, 1, "view")]
    got = {r.step: r.users for r in behaviour.funnel(ev(spark, rows), ["signup", "view"]).collect()}
    assert got == {"signup": 0, "view": 0}


def test_auc_with_ties_matches_pairwise_definition(spark):
    rng = np.random.default_rng(9)
    s = rng.integers(0, 10, 400).astype(float)
    y = (rng.random(400) < 0.3 + 0.04 * s).astype(int)
    got = evaluate.auc_rank_sum(spark.createDataFrame(pd.DataFrame({"s": s, "y": y})), "s", "y").first()
    pos, neg = s[y == 1], s[y == 0]
    exp = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert got.auc == pytest.approx(exp, abs=1e-9)
    assert (got.positives, got.negatives) == (len(pos), len(neg))


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "s double, y int")
    assert evaluate.auc_rank_sum(df, "s", "y").first().auc is None


def test_welch_matches_numpy(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(10, 2, 50), rng.normal(11, 5, 80)
    pdf = pd.DataFrame({"g": ["a"] * 50 + ["b"] * 80, "x": np.concatenate([a, b])})
    r = evaluate.welch_t(spark.createDataFrame(pdf), "x", "g", "a", "b").first()
    va, vb = a.var(ddof=1) / 50, b.var(ddof=1) / 80
    assert r.t == pytest.approx((a.mean() - b.mean()) / np.sqrt(va + vb), abs=1e-6)
    assert r.dof == pytest.approx((va + vb) ** 2 / (va ** 2 / 49 + vb ** 2 / 79), abs=1e-6)


def test_exact_duplicates_fold_case_and_whitespace(spark):
    docs = spark.createDataFrame([(3, "Hello  World"), (1, "hello world\n"), (2, "hello\tworld"), (4, "other")],
                                 "doc_id long, text string")
    got = sorted(tuple(r) for r in clean.exact_duplicates(docs).collect())
    assert got == [(1, 1, 3), (2, 1, 3), (3, 1, 3)]


def test_hash_split_is_stable_and_roughly_80_20(spark):
    df = spark.range(20000).withColumnRenamed("id", "doc_id")
    a = clean.hash_split(df, "doc_id")
    b = clean.hash_split(df.repartition(13), "doc_id")
    assert a.exceptAll(b).count() == 0
    share = a.where("split = 'train'").count() / 20000
    assert 0.78 < share < 0.82


def test_hourly_counts_fill_gaps(spark):
    rows = [(1, T0, 1, "view"), (2, T0 + dt.timedelta(hours=3, minutes=5), 1, "view")]
    got = [(r.hour, r.n) for r in behaviour.hourly_counts(ev(spark, rows)).orderBy("hour").collect()]
    assert got == [(T0 + dt.timedelta(hours=h), n) for h, n in [(0, 1), (1, 0), (2, 0), (3, 1)]]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (24.99,), (25.0,), (500.0,), (None,)], "value double")
    got = {r.bin: r.n for r in explore.histogram(df, "value", 0.0, 500.0, 20).collect()}
    assert got == {0: 1, 1: 2, 2: 1, 21: 1}


def test_hot_user_hour_is_split_and_sessions_stay_right(spark):
    from tablewise.plans.ordered import sliced
    rng = np.random.default_rng(11)
    # user 1: 900 events inside one hour (gaps up to ~8 s); 5 other users spread out
    hot = [(i, T0 + dt.timedelta(seconds=int(s)), 1, "view")
           for i, s in enumerate(np.sort(rng.choice(3600, 900, replace=False)))]
    other = [(1000 + i, T0 + dt.timedelta(minutes=int(m)), int(u), "view")
             for i, (m, u) in enumerate(zip(rng.choice(5000, 400, replace=False), rng.integers(2, 7, 400)))]
    df = ev(spark, hot + other)
    with full_slices(spark):
        parts = sliced(df, ["user_id"], ["ts"]).where("user_id = 1").select("_pid").distinct().count()
        got = sorted((r.user_id, r.session_start, r.session_end, r.events)
                     for r in behaviour.sessions(df).collect())
    assert parts > 1
    exp = brute_sessions(df.toPandas(), pd.Timedelta(minutes=30))
    assert [(u, s.to_pydatetime(), e.to_pydatetime(), n) for u, s, e, n in exp] == got


def test_hour_truncation_ignores_daylight_saving_gaps(spark):
    from tablewise.functions.timefn import trunc_ntz
    # 02:30 on 2024-03-10 does not exist in Los Angeles (clocks jump 02:00 -> 03:00)
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 15),)], "ts timestamp_ntz")
    key = "spark.sql.session.timeZone"
    old = spark.conf.get(key)
    spark.conf.set(key, "America/Los_Angeles")
    try:
        got = df.select(trunc_ntz("hour", F.col("ts")).alias("h"), trunc_ntz("day", F.col("ts")).alias("d"),
                        trunc_ntz("minute", F.col("ts")).alias("m")).first()
    finally:
        spark.conf.set(key, old)
    assert got.h == dt.datetime(2024, 3, 10, 2) and got.d == dt.datetime(2024, 3, 10)
    assert got.m == dt.datetime(2024, 3, 10, 2, 30)


def test_null_group_keys_keep_their_rows(spark):
    # sessions and as-of: events of an unknown (null) user form their own sequence
    rows = [(1, T0, None, "view"), (2, T0 + dt.timedelta(minutes=10), None, "purchase"),
            (3, T0 + dt.timedelta(hours=2), None, "view"), (4, T0, 5, "purchase")]
    pdf = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type"]).astype({"user_id": "Int64"})
    df = spark.createDataFrame(pdf, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    with full_slices(spark):
        sess = sorted((r.user_id or 0, r.events) for r in behaviour.sessions(df).collect())
        asof = {r.event_id: r.match_id for r in behaviour.latest_before(df, "purchase", "view").collect()}
    assert sess == [(0, 1), (0, 2), (5, 1)]
    assert asof == {2: 1, 4: None}
    # target encoding: a null language is a group of its own
    lab = spark.createDataFrame([(1, None, 1), (2, None, 0), (3, "en", 1)], "doc_id long, lang string, quality int")
    enc = {r.doc_id: r.target_mean for r in clean.out_of_fold_target_mean(lab, "doc_id", "lang", "quality").collect()}
    assert enc == {1: 0.0, 2: 1.0, 3: None}
    # outliers: rows of a null group are kept and scored within that group
    vals = spark.createDataFrame([(i, None, float(i)) for i in range(8)] + [(99, None, 1000.0)],
                                 "id long, g string, v double")
    out = {r.id: r.is_outlier for r in explore.iqr_outliers(vals, "v", "g", "id").collect()}
    assert len(out) == 9 and out[99] and not out[3]
