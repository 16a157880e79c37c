"""Cut lineage: write a DataFrame once to the shared checkpoint folder.

`Dataset.checkpoint(eager=True)` runs one job to count the rows and a second
one to write the checkpoint files, and the second job recomputes every stage
after the last shuffle unless the rows are cached. Here the rows are
persisted (memory, spilling to the executors' disks) for the length of the
checkpoint only, so the expensive part runs once; afterwards the frame reads
the checkpoint files, which survive the loss of any executor, and the cache
is dropped.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

_ADAPTIVE = "spark.sql.adaptive.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """``df`` computed once and checkpointed to the session's checkpoint
    folder; keeps its partitioning (known to later plans only `in_place`)."""
    checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


@contextmanager
def in_place(spark: SparkSession):
    """Frames materialized inside are planned without adaptive execution,
    whose plans do not tell how their rows are partitioned: later joins on the
    key that such a frame is hash-partitioned on leave its rows where they are."""
    before = spark.conf.get(_ADAPTIVE)
    spark.conf.set(_ADAPTIVE, "false")
    try:
        yield
    finally:
        spark.conf.set(_ADAPTIVE, before)
