"""Mergeable aggregates: cube of distinct counts, quantile sketches."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from tablewise.operators import sketches


def rows_of(seed, n=3000):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]),
             rng.choice([None, rng.randint(0, 400), -rng.randint(0, 9), 10 ** 12 + rng.randint(0, 5)])) for _ in range(n)] \
        + [("only nulls", 9, None)] * 3


def cube(rows):
    out = {}
    for level in product((0, 1), repeat=2):
        for x, y, v in rows:
            key = (None if level[0] else x, None if level[1] else y, 2 * level[0] + level[1])
            out.setdefault(key, set()).update([] if v is None else [v])
    return {k: len(v) for k, v in out.items()}


def test_cube_of_distinct_counts(spark):
    rows = rows_of(1)
    df = spark.createDataFrame(rows, "x string, y int, v long")
    got = sketches.distinct_cube(df, ["x", "y"], "v", "n").collect()
    assert {(r["x"], r["y"], r["level"]): r["n"] for r in got} == cube(rows) and len(got) == len(cube(rows))
    assert all(r["sketch_close"] for r in got)
    assert sketches.distinct_cube(df.limit(0), ["x", "y"], "v").count() == 0


def test_cells_merge_in_any_order_and_part(spark):
    """Sketches and bitmaps of parts of the rows, made apart, give the same."""
    df = spark.createDataFrame(rows_of(2), "x string, y int, v long")
    parts = [df.where(F.pmod(F.hash("x", "y", "v"), F.lit(3)) == k) for k in range(3)]
    for make, merge in ((sketches.bitmap_cells, sketches.bitmap_cube), (sketches.sketch_cells, sketches.sketch_cube)):
        whole = merge(make(df, ["x", "y"], "v"), ["x", "y"], "n")
        for order in ((0, 1, 2), (2, 0, 1)):
            cells = make(parts[order[0]], ["x", "y"], "v")
            for k in order[1:]:
                cells = cells.unionByName(make(parts[k], ["x", "y"], "v"))
            got = merge(cells, ["x", "y"], "n")
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


@pytest.mark.parametrize("lg_k", [9, 12])
def test_sketch_error_bound(spark, lg_k):
    df = spark.range(300_000).selectExpr("id % 7 AS x", "concat('user', id % 90000) AS v")
    cells = sketches.sketch_cells(df, ["x"], "v", lg_k)
    for r in sketches.sketch_cube(cells, ["x"], "n").collect():
        exact = 90_000 if r["level"] else df.where(F.col("x") == r["x"]).select("v").distinct().count()
        assert abs(r["n"] - exact) <= sketches.sketch_error(lg_k) * exact


def test_one_shuffle_of_rows_then_cells_only(spark):
    df = spark.range(1000).selectExpr("id % 3 AS x", "id % 5 AS y", "id + 1 AS v")
    cells = sketches.bitmap_cells(df, ["x", "y"], "v")
    assert cells.count() == 15
    plan = sketches.bitmap_cube(cells, ["x", "y"], "n")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "distinct" not in plan.lower() and plan.count("Exchange hashpartitioning") == 3


def test_quantile_sketches(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randint(0, 9), rng.choice([rng.gauss(0, 1), 0.0, None])) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "g string, day int, v double")
    probs = (0.05, 0.25, 0.5, 0.9)
    cells = sketches.quantile_cells(df, ["g", "day"], "v")
    for by in (["g"], ["day"], ["g", "day"], []):
        found = sketches.quantiles(cells, by, probs)
        errors = sketches.rank_errors(df, found, by, "v", probs).collect()
        for r in errors:
            assert all(r[f"error{100 * p:g}"] <= 0.02 for p in probs)
            want = sum(v is not None and all(r[b] == dict(g=g, day=d)[b] for b in by) for g, d, v in rows)
            assert r["n"] == want
        assert {r["n"] for r in found.collect()} == {r["n"] for r in errors}
    assert sketches.quantiles(cells.limit(0), ["g"], probs).count() == 0 == sketches.quantiles(cells.limit(0), [], probs).count()


def test_quantiles_against_the_exact_quartiles(spark):
    """P06's exact quartiles: the sketch's value has a rank within one percent."""
    from small import SF_SMALL
    from tablewise.plans.ranking import exact_percentiles
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_type", F.col("ts").cast("date").alias("day"), "value")
    found = sketches.quantiles(sketches.quantile_cells(e, ["event_type", "day"], "value"), ["event_type"], (0.25, 0.75))
    spread = {r["event_type"]: (r["p24"], r["p26"], r["p74"], r["p76"])
              for r in exact_percentiles(e, "value", [0.24, 0.26, 0.74, 0.76], ["event_type"]).collect()}
    for r in found.collect():
        a, b, c, d = spread[r["event_type"]]
        assert a <= r["q25"] <= b and c <= r["q75"] <= d
