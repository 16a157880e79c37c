"""Hard-negative mining by a secondary sort.

Vectors are quantised (each component x to floor(scale * x)) and scored by
their integer inner product. An anchor's positives are its best ``positives``
other rows of its label; each positive opens a window of scores, from ``low``
to ``high`` percent of its own, and takes the first ``negatives`` rows of
other labels inside. Higher scores come first, ties by smaller id.

1. Anchors (a stated query set: rows whose id is divisible by ``every``) are
   dealt into chunks of about ``anchor_block``, all rows into slices of about
   ``block``, and every chunk meets every slice in a cell of its own: one
   shuffle without a join, a broadcast or a hot key. A cell reads its anchors,
   then its rows by id, and scores them by a matrix product.
2. First pass: per anchor and cell the best positives, which are combined per
   anchor. Second pass, with the windows known: per anchor, window and cell
   the first rows inside. So what goes on is a bounded number of pairs per
   anchor and cell, and no pair that could be in the result is left out.
3. The pairs are packed into keys (anchor, falling score, positives before
   negatives, id) and go through ``repartitionAndSortWithinPartitions``, dealt
   by anchor. A streaming iterator reads the sorted keys: a positive opens a
   window, a negative is emitted for every open window it lies in that is not
   full yet. Of an anchor it holds its open windows only.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; a null id is no anchor, and as a partner it comes
before all others and is returned as null; a repeated row is a row of its
own, and a repeated anchor returns its result once per row; vectors of
different lengths are not compared; equal scores go by id; a positive with a
negative score has an empty window; scores that do not fit in a long are cut
to its range; without anchors, or on an empty table, there are no rows; other
columns are left behind, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, map_batches, map_stream, settle

EXACT = 1 << 53  # whole numbers up to here are exact as doubles
LONG = (1 << 63) - 1
OFFSET = 1 << 63  # signed to unsigned, order kept
KEY = ">QQBQQ"  # anchor, falling score, 0 for positives, id, row
PAIRS = "anchor long, anchor_id long, score long, vec_id long, row long"


def usable(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(row, vec_id, label, raw)`` of the rows that take part: a number of
    the row's own, its id (null as NULL_ID) and label, the quantised vector
    as bytes of doubles."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("vec_id"),
                          F.col(label_col).cast("long").alias("label"), F.when(finite, v).alias("v")) \
        .where("label IS NOT NULL AND v IS NOT NULL")

    def quantise(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = [np.floor(scale * np.array(x, "<f8")).tobytes() for x in batch.column("v").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(raw, pa.binary())],
                                          ["vec_id", "label", "raw"])
    return map_batches(rows, quantise, "vec_id long, label long, raw binary") \
        .withColumn("row", F.monotonically_increasing_id())


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: as doubles while they hold
    them, as Python's integers beyond."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < EXACT:
        return (a @ b.T).astype(np.int64)
    wide = [[int(x) for x in row] for row in b]
    out = [[max(-LONG, min(LONG, sum(x * y for x, y in zip(map(int, row), other)))) for other in wide] for row in a]
    return np.array(out, np.int64).reshape(len(a), len(b))


def windows_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Smallest and largest whole s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def dealt(anchors: DataFrame, rows: DataFrame, chunks: int, slices: int) -> DataFrame:
    """All cells: the anchors (``kind`` 0), then the rows by id."""
    def own(n: int):
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    if "scores" not in anchors.columns:
        anchors = anchors.withColumn("scores", F.lit(None).cast("array<long>"))
    a = anchors.withColumn("kind", F.lit(0)).withColumn("chunk", own(chunks)).withColumn("slice", every(slices))
    b = (rows.withColumn("scores", F.lit(None).cast("array<long>")).withColumn("kind", F.lit(1))
         .withColumn("slice", own(slices)).withColumn("chunk", every(chunks)))
    return (a.unionByName(b).select("chunk", "slice", "kind", "vec_id", "row", "label", "raw", "scores")
            .repartition("chunk", "slice").sortWithinPartitions("chunk", "slice", "kind", "vec_id", "row"))


class Side:
    """Rows of a cell with vectors of one length."""

    def __init__(self, rows: list[tuple]):
        self.rows, self.ids, self.labels = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        self.vectors = np.frombuffer(b"".join(r[3] for r in rows), "<f8").reshape(len(rows), -1)
        self.scores = [r[4] for r in rows]


def by_length(rows: list[tuple]) -> dict[int, Side]:
    found: dict[int, list[tuple]] = {}
    for r in rows:
        found.setdefault(len(r[3]), []).append(r)
    return {n: Side(some) for n, some in found.items()}


def scored(batches: Iterator[pa.RecordBatch], block: int, pick: Callable[..., list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """What ``pick`` takes for every anchor of a cell, at most two blocks of
    rows at a time. ``pick`` gets an anchor's place, the anchors, the rows and
    the anchor's scores, and returns places of rows."""
    cell, anchors, held, sides = None, [], [], {}

    def flush():
        found = []
        for n, rows in by_length(held).items():
            a = sides.get(n)
            score = products(a.vectors, rows.vectors) if a else ()
            for i, own in enumerate(score):
                at = pick(i, a, rows, own)
                found.append((np.full(len(at), a.rows[i]), np.full(len(at), a.ids[i]), own[at], rows.ids[at],
                              rows.rows[at]))
        held.clear()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)],
                                             ["anchor", "anchor_id", "score", "vec_id", "row"])
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("chunk", "slice", "kind", "row", "vec_id", "label", "raw", "scores")]
        for chunk, part, kind, *row in zip(*cols):
            if (chunk, part) != cell:
                yield from flush()
                cell, anchors, sides = (chunk, part), [], {}
            if kind == 0:
                anchors.append(row)
                continue
            if anchors:
                sides, anchors = by_length(anchors), []
            if sides:
                held.append(row)
            if len(held) == 2 * block:
                yield from flush()
    yield from flush()


def best_positives(positives: int) -> Callable[..., np.ndarray]:
    def pick(i: int, a: Side, b: Side, score: np.ndarray) -> np.ndarray:
        at = np.flatnonzero((b.labels == a.labels[i]) & (b.rows != a.rows[i]))  # by id
        return at[np.argsort(-score[at], kind="stable")[:positives]]
    return pick


def first_negatives(negatives: int, low: int, high: int) -> Callable[..., np.ndarray]:
    def pick(i: int, a: Side, b: Side, score: np.ndarray) -> np.ndarray:
        spans = [windows_of(s, low, high) for s in a.scores[i]]
        least, most = min(x for x, _ in spans), max(y for _, y in spans)
        at = np.flatnonzero((b.labels != a.labels[i]) & (score >= least) & (score <= most))
        at = at[np.argsort(-score[at], kind="stable")]
        falling, taken = -score[at], np.zeros(len(at), bool)
        for x, y in spans:
            first = int(np.searchsorted(falling, -y))
            taken[first:min(first + negatives, int(np.searchsorted(falling, -x, "right")))] = True
        return at[taken]
    return pick


def packed_key(anchor: int, score: int, kind: int, vec_id: int, row: int) -> bytes:
    """Bytes whose order is that of (anchor, falling score, kind, id, row)."""
    return struct.pack(KEY, anchor, LONG - score, kind, vec_id + OFFSET, row)


def mined(keys: Iterator[tuple[bytes, int]], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor id, positive, rank, negative, positive score, negative score)
    from sorted (key, anchor id)."""
    anchor, opened = None, []  # windows: [low, high, taken, positive, its score]
    for key, anchor_id in keys:
        number, falling, kind, vec_id, _ = struct.unpack(KEY, key)
        if number != anchor:
            anchor, opened = number, []
        score, vec_id = LONG - falling, vec_id - OFFSET
        vec_id = None if vec_id == NULL_ID else vec_id
        if kind == 0:
            opened.append([*windows_of(score, low, high), 0, vec_id, score])
            continue
        for window in opened:
            if window[0] <= score <= window[1]:
                window[2] += 1
                yield anchor_id, window[3], window[2], vec_id, window[4], score
        # Scores only fall: windows that are full or lie above are done with.
        opened = [w for w in opened if w[2] < negatives and score >= w[0]]


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: int = 256, every: int = 100, block: int = 4096, anchor_block: int = 1024,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``."""
    rows = settle(usable(vectors, scale, id_col, vector_col, label_col))
    anchors = rows.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != NULL_ID))
    chunks, slices = max(1, -(-anchors.count() // anchor_block)), max(1, -(-rows.count() // block))

    best = best_positives(positives)
    near = map_stream(dealt(anchors, rows, chunks, slices), lambda b: scored(b, block, best), PAIRS)
    # A bounded number of rows per anchor and cell; only the best go on.
    order = F.struct((-F.col("score")).alias("s"), "vec_id", "row")
    near = settle(near.groupBy("anchor", "anchor_id")
                  .agg(F.slice(F.sort_array(F.collect_list(order)), 1, positives).alias("best")))
    known = near.select(F.col("anchor").alias("row"), F.array_distinct(F.transform("best", lambda p: -p["s"])).alias("scores"))
    first = first_negatives(negatives, low, high)
    far = settle(map_stream(dealt(anchors.join(known, "row"), rows, chunks, slices), lambda b: scored(b, block, first),
                            PAIRS))
    near = near.select("anchor", "anchor_id", F.explode("best").alias("p")) \
        .select("anchor", "anchor_id", (-F.col("p.s")).alias("score"), "p.vec_id", "p.row")

    both = near.withColumn("kind", F.lit(0)).unionByName(far.withColumn("kind", F.lit(1)))
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = (both.rdd.map(lambda r: (packed_key(r["anchor"], r["score"], r["kind"], r["vec_id"], r["row"]), r["anchor_id"]))
              .repartitionAndSortWithinPartitions(parts, lambda key: struct.unpack(KEY, key)[0] * 0x9E3779B97F4A7C15 >> 32)
              .mapPartitions(lambda keys: mined(keys, negatives, low, high)))
    return spark.createDataFrame(ranked, "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
