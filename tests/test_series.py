"""Change points against all segmentations, bootstrap against plain loops."""

import datetime as dt
import math
import random
from itertools import combinations

import numpy as np
import pytest

from tablewise.operators import resample, series

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 2, 27)


def cost(x, starts, penalty):
    ends = [*starts[1:], len(x)]
    return sum(((x[a:b] - x[a:b].mean()) ** 2).sum() + penalty for a, b in zip(starts, ends)) - penalty


@pytest.mark.parametrize("seed", range(6))
def test_segments_are_optimal(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 8, 11).astype(float) + np.repeat([0, 5, 1], [4, 3, 4]) * (seed % 3)
    for penalty in (0.5, 4.0, 30.0):
        every = [[0, *c] for k in range(11) for c in combinations(range(1, 11), k)]
        least = min(cost(x, s, penalty) for s in every)
        assert cost(x, series.best_segments(x, penalty), penalty) == pytest.approx(least)


def test_pruning_keeps_the_optimum_of_long_series():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.poisson(m, 80) for m in (20, 60, 5, 30)]).astype(float)
    s, q = np.concatenate(([0], np.cumsum(x))), np.concatenate(([0], np.cumsum(x * x)))
    best = [-200.0]
    for t in range(1, len(x) + 1):
        best.append(min(best[j] + q[t] - q[j] - (s[t] - s[j]) ** 2 / (t - j) for j in range(t)) + 200.0)
    starts = series.best_segments(x, 200.0)
    assert cost(x, starts, 200.0) == pytest.approx(best[-1])
    assert [min(abs(a - b) for b in starts) <= 1 for a in (0, 80, 160, 240)] == [True] * 4


def event_rows(counts, group):
    return [(group, START + i * DAY + dt.timedelta(hours=h % 24)) for i, n in enumerate(counts) for h in range(n)]


def test_counts_gaps_groups_and_units(spark):
    rows = (event_rows([5] * 6 + [0] * 3 + [30] * 6, "a") + event_rows([4, 4, 4], None) + event_rows([7], "b")
            + [("c", None)])
    d = spark.createDataFrame(rows, "g string, t timestamp_ntz").selectExpr("*", "1 AS u", "2 AS n")
    got = sorted((str(r["g"]), r["segment"], (r["first"] - START).days, (r["last"] - START).days, r["units"], r["mean"])
                 for r in series.count_change_points(d, "g", "t").collect())
    assert got == [("None", 1, 0, 2, 3, 4.0), ("a", 1, 0, 8, 9, 3.333333), ("a", 2, 9, 14, 6, 30.0), ("b", 1, 0, 0, 1, 7.0)]
    assert series.count_change_points(d.where("g = 'zz'"), "g", "t").count() == 0
    week = series.count_change_points(d.where("g = 'b'"), "g", "t", "week").first()
    assert week["first"] == dt.datetime(2024, 2, 26)  # a Monday
    hour = series.count_change_points(d.where("g = 'b'"), "g", "t", "hour").first()
    assert (hour["first"], hour["last"], hour["units"]) == (START, START + dt.timedelta(hours=6), 7)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_days_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    rows = [("a", dt.datetime(2024, 3, 9) + i * dt.timedelta(hours=1)) for i in range(72)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        d = spark.createDataFrame(rows, "g string, t timestamp_ntz")
        r = series.count_change_points(d, "g", "t").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [(x["first"], x["last"], x["units"], x["mean"]) for x in r] == [
        (dt.datetime(2024, 3, 9), dt.datetime(2024, 3, 11), 3, 24.0)]


def test_rows_of_a_key_are_drawn_together_and_the_same_every_time(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(40), rng.choice([None, float("nan"), float("inf"), -1.25, 3.5, 7.1]))
            for _ in range(600)] + [("a", None, 2.0), ("one", 3, 2.5), ("one", 3, 3.5), ("none", 1, None)]
    d = spark.createDataFrame(rows, "g string, k long, v double").selectExpr("*", "1 AS a", "2 AS x", "3 AS r")
    draws = {(r["k"], r["r"]): r["x"] for r in resample.draw(
        spark.range(2000).selectExpr("id % 40 AS k", "id DIV 40 + 1 AS r"), "k", "r").collect()}
    bounds = resample.poisson_bounds()
    want = {}
    for g in {r[0] for r in rows}:
        own = [(k, v) for h, k, v in rows if h == g and k is not None and v is not None and math.isfinite(v)]
        if not own:
            continue
        means = []
        for r in range(1, 51):
            w = [sum(draws[k, r] >= b for b in bounds) for k, _ in own]
            if sum(w):
                means.append(sum(x * v for x, (_, v) in zip(w, own)) / sum(w))
        means.sort()
        at = lambda s: means[math.floor((len(means) - 1) * s + 0.5)]
        want[g] = (len(own), sum(v for _, v in own) / len(own), at(0.05), at(0.95), len(means))
    for repeats, parts in ((True, 1), (True, 7), (False, 3)):
        got = {r[0]: tuple(r)[1:] for r in resample.bootstrap_means(
            d.repartition(parts), "g", "v", "k", 50, 0.9, key_repeats=repeats).collect()}
        assert set(got) == set(want)
        for g in want:
            assert got[g] == pytest.approx(want[g], abs=2e-6)
    assert got["one"][1:4] == (3.0, 3.0, 3.0)
    assert resample.bootstrap_means(d.limit(0), "g", "v", "k").count() == 0


def test_weights_are_poisson_and_unrelated(spark):
    x = spark.range(4000).selectExpr("id * 7 + 3000000000 AS k")
    for r in (1, 2, 3, 150):
        x = resample.draw(x.withColumn("r", resample.F.lit(r).cast("long")), "k", "r", f"x{r}")
    x = x.orderBy("k").select("x1", "x2", "x3", "x150").toPandas()
    w = (x.to_numpy()[:, :, None] >= np.array(resample.poisson_bounds())).sum(axis=2)
    assert np.allclose(w.mean(axis=0), 1, atol=0.06) and np.allclose(w.var(axis=0), 1, atol=0.12)
    c = np.corrcoef(np.concatenate([w.T, np.roll(w, 1, axis=0).T]))
    assert np.abs(c - np.eye(8)).max() < 0.06


def test_intervals_cover_the_mean(spark):
    # 200 samples of 150 values: 95 % intervals should hold the true mean about
    # 190 times; fewer than 176 has a chance below 1 in 1,000 at 93 %.
    rng = np.random.default_rng(8)
    rows = [(g, g * 1000 + i, float(v)) for g in range(200) for i, v in enumerate(rng.exponential(2.0, 150))]
    d = spark.createDataFrame(rows, "g long, k long, v double")
    out = resample.bootstrap_means(d, "g", "v", "k", key_repeats=False).collect()
    assert 176 <= sum(r["low"] <= 2.0 <= r["high"] for r in out) <= 199


def test_sums_are_made_before_the_shuffle(spark):
    d = spark.range(1000).selectExpr("id % 2 AS g", "id AS k", "double(id) AS v")
    plan = resample.bootstrap_means(d, "g", "v", "k", key_repeats=False)._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "Exchange" in x or "Generate" in x or "partial_sum" in x]
    exchange = [i for i, x in enumerate(lines) if "Exchange hashpartitioning(g" in x]
    generate = next(i for i, x in enumerate(lines) if "Generate" in x)
    assert all(i < generate for i in exchange) and any("partial_sum" in x for x in lines[:generate])
