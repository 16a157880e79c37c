"""Every query with SQL matches DuckDB on the smallest tables: same column
names and types, same multiset of rows."""

import pytest

from oracle_check import compare
from tablewise.catalog import REGISTRY

from small import SF_SMALL

WITH_SQL = sorted(n for n, q in REGISTRY.items() if q.sql)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_duckdb(spark, duck, name):
    q = REGISTRY[name]
    res = compare(q.build(spark, SF_SMALL), duck, q.sql)
    assert res["cols_match"], res
    assert not res["types"], res["types"]
    assert res["rows_spark"] == res["rows_duck"]
    assert res["values_match"], (res["only_spark"], res["only_duck"])


def test_registry_covers_survey_ids():
    ids = sorted(q.survey_id for q in REGISTRY.values())
    assert [i for i in ids if i[0] == "P"] == [f"P{i:02d}" for i in range(1, 34)]
    assert len(set(ids)) == len(ids) and all(i[0] in "PM" for i in ids)  # M: not in the survey's plan


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
