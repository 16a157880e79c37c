"""What a join on hot keys sends through a shuffle."""

from tablewise.plans.keys import skew_join


def test_skew_join_sends_a_short_key(spark):
    left = spark.createDataFrame([(i % 5, str(i)) for i in range(40)] + [(None, "x")], "k long, v string")
    right = left.groupBy("k").count()
    out = skew_join(left, right, ["k"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "tinyint" in plan
    assert out.columns == ["k", "v", "count"]
    assert sorted(map(tuple, out.collect())) == sorted((i % 5, str(i), 8) for i in range(40))
