"""From raw documents to packed training sequences.

STAGES lists the stages in order. Each takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's docs; all but the last return the columns of documents. ``n_chars``,
where present, follows the text.

1. quality rules: documents that they reject go.
2. line dedup: lines of repeated three-line windows go but for their first
   occurrence; the documents stay.
3. n-gram Jaccard join: of documents linked at a similarity of 0.8 of
   five-word shingles, the one with the smallest doc_id stays, each text
   judged by itself where several share an id; of rows equal in id and text
   one stays. Rows without an id stay.
4. suffix-array dedup: bytes covered by a 200-byte string that occurs
   elsewhere go; the documents stay, even if nothing is left of them.
5. best-fit packing: the place of every piece of every document in
   sequences of 4096 tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.llm.line_dedup import dedup_lines
from tablewise.llm.ngram_join import jaccard_rows
from tablewise.llm.packing import pack
from tablewise.llm.quality_rules import passing
from tablewise.llm.suffix_dedup import without_repeats
from tablewise.session import checkpoint_dir
from tablewise.sources.tables import load


def with_length(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` set to the text's length, if it is there."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return passing(docs, load(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated three-line windows."""
    return with_length(dedup_lines(docs).drop("_gone"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    found = jaccard_rows(docs)
    gone = (found.where("doc_id != first.kid or ksum != first.ksum")
            .select(F.col("doc_id").alias("_id"), F.col("ksum").alias("_text")).distinct())
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    kept = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_text": F.xxhash64(text)})
    return (kept.join(gone, ["_id", "_text"], "left_anti").dropDuplicates(["_id", "_text"])
            .select(*docs.columns))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without byte strings that occur elsewhere."""
    return with_length(without_repeats(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences."""
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("best-fit packing", packing),
]

#: The exact binomial bounds, the byte-wise repeated windows and the packing
#: have no SQL form; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the session's
    shared folder and read again."""
    base = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
