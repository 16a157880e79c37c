"""Token ids on disk in patched frame-of-reference blocks.

Format. A dataset of Parquet files that Spark writes, one file per task, in
ascending document order. A row is a page: a run of whole documents with

  file, page       place of the page
  first, n_ids     ids before it in its file; ids in it
  doc_ids, lens    its documents (the id may be null) and their lengths in ids
  starts           index: byte offset of each block in ``payload`` (uint32)
  payload          the blocks, one after the other

A block holds 128 ids (the last one of a page is filled up with its last
id): minimum (uint32), width (uint8), number of exceptions (uint8), the
differences from the minimum packed at that width, the exceptions' positions
(uint8) and their whole differences (uint32). All numbers are little-endian.
The width is the smallest that holds ``share`` of the block's differences;
the others are the exceptions. The packed part consists of 4 lanes: lane k
has the differences k, k + 4, k + 8, ... as consecutive bit fields in 32-bit
words, and the words of the lanes alternate.

A page is read without any other page, so a lost task repeats only its own
pages, and Spark's commit protocol keeps files of failed attempts out.

Defined cases: a null or empty text is a document of the end id alone; rows
of one id are ordered by a hash of their texts; null ids come first;
repeated rows are written each; an empty table gives no pages and no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import map_batches, map_stream, slices, texts
from .tokens import default_vocabulary, encoder

BLOCK = 128
LANES = 4
SLOTS = BLOCK // LANES
HEAD = 6
PAGE_IDS = 1 << 18

PAGE_SCHEMA = ("file int, page int, first long, n_ids long, doc_ids array<long>, lens array<long>, "
               "starts binary, payload binary")


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits needed by each unsigned value below 2**53 (0 for 0)."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack(diffs: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 128) differences, cut to ``width`` bits -> (blocks, 16 * width) bytes."""
    lanes = (diffs & np.uint64((1 << width) - 1)).reshape(len(diffs), SLOTS, LANES)
    words = np.zeros((len(diffs), width + 1, LANES), np.uint64)
    for k in range(SLOTS):
        word, shift = divmod(k * width, 32)
        v = lanes[:, k] << np.uint64(shift)
        words[:, word] |= v & np.uint64(0xFFFFFFFF)
        words[:, word + 1] |= v >> np.uint64(32)
    return np.ascontiguousarray(words[:, :width]).astype("<u4").reshape(len(diffs), -1).view(np.uint8)


def unpack(packed: np.ndarray, width: int) -> np.ndarray:
    """Inverse of ``pack``."""
    n = len(packed)
    words = np.zeros((n, width + 1, LANES), np.uint64)
    words[:, :width] = np.ascontiguousarray(packed).view("<u4").reshape(n, width, LANES)
    out = np.empty((n, SLOTS, LANES), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for k in range(SLOTS):
        word, shift = divmod(k * width, 32)
        out[:, k] = ((words[:, word] | words[:, word + 1] << np.uint64(32)) >> np.uint64(shift)) & mask
    return out.reshape(n, BLOCK)


def encode_blocks(ids: np.ndarray, share: float = 0.9) -> tuple[bytes, bytes]:
    """``ids`` (uint32) -> (index of block starts, payload)."""
    n = len(ids)
    if n == 0:
        return b"", b""
    blocks = np.full(-(-n // BLOCK) * BLOCK, ids[-1], np.uint64)
    blocks[:n] = ids
    blocks = blocks.reshape(-1, BLOCK)
    low = blocks.min(axis=1)
    diffs = blocks - low[:, None]
    bits = bit_lengths(diffs)
    rank = min(BLOCK - 1, int(np.ceil(share * BLOCK)) - 1)
    width = np.partition(bits, rank, axis=1)[:, rank]
    over = bits > width[:, None]
    n_over = over.sum(axis=1)
    sizes = HEAD + BLOCK // 8 * width + 5 * n_over
    starts = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(starts[-1], np.uint8)
    starts = starts[:-1]
    head = np.empty((len(blocks), HEAD), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4], head[:, 5] = width, n_over
    out[starts[:, None] + np.arange(HEAD)] = head
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        at = starts[rows] + HEAD
        out[at[:, None] + np.arange(BLOCK // 8 * w)] = pack(diffs[rows], w)
    row, pos = np.nonzero(over)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        tail = starts[row] + HEAD + BLOCK // 8 * width[row]
        out[tail + nth] = pos
        value_at = tail + n_over[row] + 4 * nth
        out[value_at[:, None] + np.arange(4)] = diffs[row, pos].astype("<u4").view(np.uint8).reshape(-1, 4)
    return starts.astype("<u4").tobytes(), out.tobytes()


def decode_blocks(starts: bytes, payload: bytes, n: int) -> np.ndarray:
    """The first ``n`` ids of the blocks as little-endian uint32."""
    at = np.frombuffer(starts, "<u4").astype(np.int64)
    buf = np.frombuffer(payload, np.uint8)
    if n == 0:
        return np.empty(0, "<u4")
    low = buf[at[:, None] + np.arange(4)].view("<u4").astype(np.uint64)
    width, n_over = buf[at + 4].astype(np.int64), buf[at + 5].astype(np.int64)
    out = np.zeros((len(at), BLOCK), np.uint64)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        out[rows] = unpack(buf[(at[rows] + HEAD)[:, None] + np.arange(BLOCK // 8 * w)], w)
    row = np.repeat(np.arange(len(at)), n_over)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        tail = at[row] + HEAD + BLOCK // 8 * width[row]
        pos = buf[tail + nth]
        value_at = tail + n_over[row] + 4 * nth
        out[row, pos] = buf[value_at[:, None] + np.arange(4)].view("<u4").ravel()
    return (out + low).ravel()[:n].astype("<u4")


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2,
                 share: float = 0.9) -> None:
    """Encode every text, append ``end_id`` and write the dataset at
    ``path`` in ascending doc_id order."""
    vocabulary = vocabulary or default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()
    # The texts travel rather than the ids, which compress less well. The
    # hash splits a run of equal ids into several ranges.
    ordered = (texts(docs).withColumn("ksum", F.xxhash64("text"))
               .repartitionByRange("doc_id", "ksum")
               .sortWithinPartitions("doc_id", "ksum").select("doc_id", "text"))

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        file, page, first = TaskContext.get().partitionId(), 0, 0
        ids, lens, parts, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            starts, payload = encode_blocks(np.frombuffer(b"".join(parts), "<u4"), share)
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([page], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([lens], pa.list_(pa.int64())), pa.array([starts], pa.binary()),
                 pa.array([payload], pa.binary())],
                ["file", "page", "first", "n_ids", "doc_ids", "lens", "starts", "payload"])
        for batch in (part for whole in batches for part in slices(whole)):
            for doc_id, b in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text").to_pylist())):
                b += end
                ids.append(doc_id)
                lens.append(len(b) // 4)
                parts.append(b)
                size += len(b) // 4
                if size >= PAGE_IDS:
                    yield flush()
                    page, first = page + 1, first + size
                    ids, lens, parts, size = [], [], [], 0
        if ids:
            yield flush()
    # The payload is packed already; compressing it again would cost time only.
    map_stream(ordered, pages, PAGE_SCHEMA).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` per document of a dataset: ``start``
    counts the ids of all documents before it, ``ids`` is binary
    (little-endian uint32)."""
    pages = spark.read.schema(PAGE_SCHEMA).parquet(path)

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        files, doc_ids, starts, lens, ids = [], [], [], [], []
        for row in batch.to_pylist():
            b = decode_blocks(row["starts"], row["payload"], row["n_ids"]).tobytes()
            at = 0
            for doc_id, n in zip(row["doc_ids"], row["lens"]):
                files.append(row["file"])
                doc_ids.append(doc_id)
                starts.append(row["first"] + at)
                lens.append(n)
                ids.append(b[4 * at:4 * (at + n)])
                at += n
        return pa.RecordBatch.from_arrays(
            [pa.array(files, pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()),
             pa.array(lens, pa.int64()), pa.array(ids, pa.binary())],
            ["file", "doc_id", "start", "n_tokens", "ids"])
    rows = map_batches(pages, decode, "file int, doc_id long, start long, n_tokens long, ids binary")
    # One row per file: as many as tasks wrote, safe to order and broadcast.
    before = (pages.groupBy("file").agg(F.sum("n_ids").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(
                  Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("file", "before"))
    return (rows.join(F.broadcast(before), "file")
            .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids"))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
