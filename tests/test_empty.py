"""Every registered query on empty tables: runs, and returns no rows or one
row of empty aggregates -- never an error."""

import pyarrow.parquet as pq
import pytest

from tablewise.catalog import REGISTRY
from tablewise.sources.tables import TABLES

from small import SF_SMALL


@pytest.fixture(scope="module")
def empty_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    for t in TABLES:
        pq.write_table(pq.read_table(f"{SF_SMALL}/{t}.parquet").slice(0, 0), str(d / f"{t}.parquet"))
    return str(d)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_on_empty_tables(spark, empty_dir, name):
    rows = REGISTRY[name].build(spark, empty_dir).collect()
    # Global aggregates keep one row (counts 0, statistics null); the profile
    # and correlation reports keep one row per column or pair; the funnel one
    # row per step.
    assert len(rows) <= 11
    for r in rows:
        for k, v in r.asDict().items():
            if k in ("users", "rows", "nulls", "distinct_values", "n_a", "n_b"):
                assert v in (0, None), (k, v)
