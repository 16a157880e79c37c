"""Registry of named queries: each builds a DataFrame from the tables in one
scale-factor folder, and most carry an equivalent DuckDB SQL text that the
correctness check runs on the same Parquet files.

Column names and types are kept identical between the two forms: every
computed column is aliased, counts are bigint, doubles are rounded the same
way in both, and timestamps stay timezone-free.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from .sources.tables import load_all


@dataclass(frozen=True)
class Query:
    name: str
    survey_id: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def register(name: str, survey_id: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, survey_id, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict:
    return load_all(spark, sf_dir, names)


# Importing the query modules fills REGISTRY.
from .queries import (  # noqa: E402,F401
    base_queries,
    explore_queries,
    clean_queries,
    behaviour_queries,
    evaluate_queries,
    text_vector_queries,
    stream_queries,
    interval_queries,
    frequent_queries,
    compare_queries,
    graph_queries,
    series_queries,
)
