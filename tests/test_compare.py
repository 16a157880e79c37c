"""Keyed table difference against plain counters."""

import datetime as dt
import random
from collections import Counter

from tablewise.operators import compare

NAMES = ["a", "b", "status", "rows_old", "rows_new", "rows_added", "rows_removed", "duplicates_old", "duplicates_new"]


def plain(old, new):
    out = []
    for key in {r[:2] for r in old + new}:
        o, n = (Counter(r[2:] for r in rows if r[:2] == key) for rows in (old, new))
        added, removed = sum((n - o).values()), sum((o - n).values())
        status = "added" if not o else "removed" if not n else "changed" if added + removed else "unchanged"
        out.append((*key, status, sum(o.values()), sum(n.values()), added, removed,
                    sum(o.values()) - len(o), sum(n.values()) - len(n)))
    return sorted(out, key=str)


def both(spark, old, new, schema="a int, b string, x double, y string"):
    o, n = (spark.createDataFrame(rows, schema) for rows in (old, new))
    return compare.keyed_difference(o, n, ["a", "b"], ["x", "y"], unchanged=True)


def test_difference_equals_counters(spark):
    rng = random.Random(3)
    row = lambda: (rng.choice([None, *range(12)]), rng.choice([None, "", "k"]),
                   rng.choice([None, 0.5, 1.0]), rng.choice([None, "", "null", '"']))
    old = [row() for _ in range(150)]
    new = [r for r in old if r[0] != 11 and rng.random() < 0.9] + [row() for _ in range(20)] + [(99, "k", 0.5, "")] * 2
    old += [(98, "k", 0.5, "")] * 2
    got = both(spark, old, new)
    assert got.columns == NAMES
    want = plain(old, new)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert {r[2] for r in want} == {"added", "removed", "changed", "unchanged"}


def test_null_keys_and_values(spark):
    same = [(None, None, None, None), (None, "", 0.5, "x"), (1, None, 0.5, None)]
    got = both(spark, same, same[:2] + [(1, None, None, None)])
    assert {r[:2]: r["status"] for r in map(lambda r: r, got.collect())} == {
        (None, None): "unchanged", (None, ""): "unchanged", (1, None): "changed"}


def test_empty_versions_and_clashing_names(spark):
    rows = [(1, "a", 0.5, "x")] * 2
    assert [tuple(r)[2:] for r in both(spark, rows, []).collect()] == [("removed", 2, 0, 0, 2, 1, 0)]
    assert [tuple(r)[2:] for r in both(spark, [], rows).collect()] == [("added", 0, 2, 2, 0, 0, 1)]
    assert both(spark, [], []).count() == 0
    d = spark.createDataFrame([(1, 2, 3, 4, 5)], "h int, k0 int, `in_new` int, o int, `a.b` int")
    out = compare.keyed_difference(d, d.withColumn("o", d["o"] + 1), ["h", "k0"], ["in_new", "o", "a.b"])
    assert [tuple(r) for r in out.collect()] == [(1, 2, "changed", 1, 1, 1, 1, 0, 0)]
    assert compare.keyed_difference(d, d, ["h"], ["o"]).count() == 0


def test_microseconds_count_and_a_hot_key_is_counted_before_the_shuffle(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    for kind in ("timestamp", "timestamp_ntz"):
        o, n = (spark.createDataFrame([(1, x)], f"k int, t {kind}") for x in (t, t.replace(microsecond=2)))
        assert compare.keyed_difference(o, n, ["k"], ["t"]).count() == 1
    hot = spark.range(30_000).selectExpr("id % 3 % 2 AS k", "id % 7 AS v")
    out = compare.keyed_difference(hot, hot, ["k"], ["v"], unchanged=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Join" not in plan
    assert sorted((r["k"], r["rows_old"], r["status"]) for r in out.collect()) == [
        (0, 20_000, "unchanged"), (1, 10_000, "unchanged")]
