"""Property-based checks of the skew-safe helpers on random small frames."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewise.operators.behaviour import moving_average
from tablewise.plans.ranking import exact_percentiles, global_row_index

rows = st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5)), min_size=1, max_size=60)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows, st.integers(1, 6))
def test_row_index_is_sorted_permutation(spark, data, parts):
    pdf = pd.DataFrame(data, columns=["g", "v"])
    got = global_row_index(spark.createDataFrame(pdf), ["g", "v"], "i", num_partitions=parts).toPandas()
    assert sorted(got.i) == list(range(len(pdf)))
    assert got.sort_values("i")[["g", "v"]].values.tolist() == pdf.sort_values(["g", "v"]).values.tolist()


@SETTINGS
@given(rows, st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 1.0]))
def test_percentiles_equal_numpy_linear(spark, data, p):
    pdf = pd.DataFrame(data, columns=["g", "v"]).astype({"v": float})
    got = exact_percentiles(spark.createDataFrame(pdf), "v", [p], ["g"]).toPandas().set_index("g")
    col = got.columns[0]
    for g, part in pdf.groupby("g"):
        assert abs(got.loc[g, col] - np.percentile(part.v, p * 100)) < 1e-9


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.floats(-100, 100, allow_nan=False)), min_size=1, max_size=50),
       st.integers(1, 5))
def test_moving_average_equals_rolling(spark, data, w):
    pdf = pd.DataFrame(data, columns=["k", "x"])
    pdf["o"] = np.arange(len(pdf), dtype="int64")
    got = moving_average(spark.createDataFrame(pdf), "k", ["o"], "x", rows=w, digits=6).toPandas().set_index("o")
    exp = pdf.groupby("k").x.transform(lambda s: s.rolling(w, min_periods=1).mean())
    assert np.allclose(got.loc[pdf.o, "moving_avg"].values, exp.values, atol=1e-5)
