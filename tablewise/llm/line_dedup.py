"""Line de-duplication by overlapping three-line windows.

Every three consecutive lines of a text are a window. A window that occurs
more than once is kept where it occurs first (smallest doc_id, then text
hash, then position); the lines of its later occurrences are removed, the
overlapping windows of one text merged into runs. A later occurrence that
overlaps the first one in the same text removes only the lines beyond it.

Windows are compared by the MD5 of their lines. Only windows that occur more
than once are joined back to their occurrences, and the first occurrences are
found by a partial aggregate, so a window that a third of all texts share is
one row per task in that shuffle and a splittable key in the join.

Defined cases: null ids and texts are kept as they are; a text of fewer than
three lines has no window and stays; blank lines are lines; rows equal in id
and text are one occurrence, so neither loses lines to the other; an empty
table gives an empty result; extra columns are kept by ``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, settle

WINDOW = 3


def _key(docs: DataFrame) -> tuple[Column, Column, Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return text, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("kid"), F.xxhash64(text).alias("ksum")


def removed_lines(docs: DataFrame) -> DataFrame:
    """``(kid, ksum, gone)`` for every text that loses lines: ``gone`` is the
    sorted array of 0-based line numbers."""
    text, kid, ksum = _key(docs)
    lines = docs.select(kid, ksum, F.split(text, "\n").alias("lines")).where(F.size("lines") >= WINDOW)
    windows = lines.select("kid", "ksum", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("lines") - (WINDOW - 1)),
        lambda i: F.unhex(F.md5(F.array_join(F.slice("lines", i, WINDOW), "\n").cast("binary"))))).alias("pos", "hash"))
    place = F.struct("kid", "ksum", "pos")
    # More than one place: the smallest and the largest differ.
    first = settle(windows.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                        .where("first != last").select("hash", "first"))
    later = (windows.join(first, "hash")
             .withColumn("same", (F.col("first.kid") == F.col("kid")) & (F.col("first.ksum") == F.col("ksum")))
             .where(~F.col("same") | (F.col("first.pos") != F.col("pos")))
             .select("kid", "ksum",
                     F.when(F.col("same"), F.greatest(F.col("pos"), F.col("first.pos") + WINDOW))
                     .otherwise(F.col("pos")).alias("a"),
                     (F.col("pos") + (WINDOW - 1)).alias("b"))
             .where("a <= b"))
    covered = later.select("kid", "ksum", F.explode(F.sequence("a", "b")).alias("line"))
    return covered.groupBy("kid", "ksum").agg(F.sort_array(F.collect_set("line")).alias("gone"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated windows' lines taken out of ``text`` and
    an array ``_gone`` of the removed line numbers (null if none is). Columns
    keep their names and order."""
    text, kid, ksum = _key(docs)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    # The lines pass through the join as an array, so that they are split
    # once and looked up by number.
    wide = docs.select(*others, F.split(F.col("text").cast("string"), "\n").alias("_lines"),
                       kid.alias("_kid"), ksum.alias("_ksum"))
    gone = removed_lines(docs).select(F.col("kid").alias("_kid"), F.col("ksum").alias("_ksum"),
                                      F.col("gone").alias("_gone"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    kept = F.transform(left, lambda i: F.element_at("_lines", i + 1))
    out = wide.join(gone, ["_kid", "_ksum"], "left").withColumn(
        "text", F.array_join(F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(kept), "\n"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "_gone")
