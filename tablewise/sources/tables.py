"""Readers for the Parquet tables the package works on.

Readers only declare the scan; Catalyst prunes it to the columns a query
uses and pushes its filters into the Parquet reader (`PushedFilters`).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(path(sf_dir, name))


def load_all(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: load(spark, sf_dir, n) for n in names}


def files_of(spark: SparkSession, sf_dir: str, name: str) -> list[tuple[str, int, str]]:
    """Path, size and modification time of the table's files, sorted; the
    files are listed and not read."""
    found = spark.read.format("binaryFile").load(path(sf_dir, name))
    return sorted(tuple(r) for r in found.selectExpr("path", "length", "cast(unix_micros(modificationTime) AS string)")
                  .collect())


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """`events` as a streaming source, stored as one file or as a folder of
    part files; files that arrive in the folder later are picked up. Fails
    if there is no file to read."""
    at = path(sf_dir, "events")
    batch = spark.read.parquet(at)
    if not batch.inputFiles():
        raise FileNotFoundError(f"no data file in {at}")
    reader = spark.readStream.schema(batch.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # Written as a pattern, which matches this one path, the source accepts a
    # single file as well as a folder.
    return reader.parquet(f"{at[:-1]}[{at[-1]}]")
