"""Small helpers the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# ASCII white space: the only characters that separate words here.
SPACES = b" \t\n\r\x0b\x0c"

# Rows of an Arrow batch, and bytes of it that are worked on at once.
BATCH_ROWS = 1000
SLICE_BYTES = 4 << 20

# Stands for a null id where ids are joined or ordered (null sorts first).
NULL_ID = -(1 << 63)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, text binary)`` of every row; a null text is empty.
    Other columns are left behind, so their names cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def map_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
               schema: str) -> DataFrame:
    """``df.mapInArrow`` whose Python workers can import this package from
    where the driver did, whatever folder they start in. (On a cluster the
    package is installed or sent along with --py-files.)

    Rows are texts, so Spark's default of 10,000 rows a batch would hold tens
    of megabytes several times over in each task; where the session has that
    default, batches are set to BATCH_ROWS rows. Other settings stay."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:  # workers are used again: what the task held goes back to the system
            pa.default_memory_pool().release_unused()
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about SLICE_BYTES: a batch holds
    thousands of rows, and what is made of them should not be in memory at
    once."""
    step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to each slice of the Arrow batches of ``df``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield fn(part)
    return map_stream(df, run, schema)


def settle(df: DataFrame, rows_per_file: int = 20_000) -> DataFrame:
    """``df`` computed once and checkpointed to the session's shared folder,
    in files of about ``rows_per_file`` rows: most of the tables that cut a
    lineage here are small, and as many files as the shuffle had partitions
    would cost more than their rows. The rows are made at full parallelism,
    held in memory and on the executors' disks until the files are written,
    and read from the files afterwards."""
    checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        files = max(1, -(-cached.count() // rows_per_file))
        return cached.coalesce(files).checkpoint(eager=True)
    finally:
        cached.unpersist()


def train_fold(doc_id: Column | str) -> Column:
    """crc32 of the id's decimal text modulo 5; 0 is the held-out fold."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5


def binary_labels(labels: DataFrame, name: str) -> DataFrame:
    """``(doc_id, label)`` with one row per id: null ids, null labels and
    values other than 0 and 1 are left out; of repeated ids the larger label
    counts."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def labelled_sample(docs: DataFrame, labels: DataFrame, name: str, per_class: int,
                    sample_bytes: int) -> tuple[list[tuple[bytes, int]], float]:
    """At most ``per_class`` labelled texts of either label outside the
    held-out fold, in a fixed pseudo-random order, and the share of label 1
    among all training labels."""
    known = binary_labels(labels, name).where(train_fold("doc_id") != 0)
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    d = texts(docs).where(F.col("doc_id").isNotNull() & (train_fold("doc_id") != 0)
                          & (F.length("text") <= sample_bytes))
    rows: list[tuple[bytes, int]] = []
    for label in (0, 1):
        # Of the ids that have a text that fits; ids only travel.
        ids = (known.where(F.col("label") == label).join(d.select("doc_id"), "doc_id", "left_semi")
               .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class))
        picked = (d.join(F.broadcast(ids), "doc_id")
                  .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(per_class))
        rows += [(bytes(r["text"]), r["label"]) for r in picked.select("text", "label").collect()]
    return rows, counts.get(1, 0) / total if total else 0.5
