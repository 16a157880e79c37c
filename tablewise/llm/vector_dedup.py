"""Embedding near-duplicates with cross-polytope hashing.

Equal vectors are one node with a number of copies. A node is hashed
``tables`` times: each table draws ``parts`` pseudo-random rotations (three
rounds of random signs and a fast Hadamard transform) and names, for each,
the coordinate with the largest absolute value and its sign. Multiprobe: the
node enters, per table, the buckets of its ``probes`` best names, so two
nodes meet if any of their names agree. Pairs that meet are verified by
cosine in double precision, so no reported link is wrong; ``parts`` grows
with the logarithm of the number of nodes, which keeps buckets of unrelated
vectors small.

A node meets the others of its buckets twice. First as a sketch of 32 bytes:
the head of one more rotation, rounded, and the length of the rest. By
Cauchy-Schwarz it bounds the cosine from above, so a node that no other of a
bucket can reach leaves that bucket and no link is lost. Only what is left,
mostly real near-duplicates, is joined with its vector and verified.

A bucket larger than ``block`` nodes is dealt into blocks, and every two
blocks meet in a task of their own: a bucket of any size is whole, and no
task holds more than two blocks. A pair that meets several times counts in
the smallest of its common buckets. What leaves a task is, per node, its
number of links and one edge to the smallest node of its local component;
pairs themselves are never written. Components come from those edges.

Defined cases: a vector that is null, empty, zero, or holds a null or a
non-finite component links with nothing and stays; vectors of different
lengths never link; repeated rows are links of each other; null ids sort
before all others; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.broadcast import bounded_broadcast
from .common import NULL_ID, map_batches, map_stream, settle
from .components import components

# A sketch is HEAD rounded coordinates and the length of the rest, a byte each.
HEAD = 31


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (length a power of two)."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(n, d)
        h *= 2
    return x


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1])) / math.sqrt(x.shape[1])
    return x


def bucket_names(x: np.ndarray, tables: int, parts: int, probes: int) -> np.ndarray:
    """(rows, tables, probes) bucket names of unit vectors: per table the
    ``probes`` best combinations of the parts' names. Of each part the two
    best names are considered; a combination loses what its names lack of
    the best value."""
    n, d = x.shape
    width = 1 << max(0, d - 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :d] = x
    out = np.empty((n, tables, probes), np.int64)
    choices = np.array([[c >> p & 1 for p in range(parts)] for c in range(1 << parts)])
    for t in range(tables):
        names, loss = np.empty((n, parts, 2), np.int64), np.empty((n, parts))
        for p in range(parts):
            r = rotate(padded, 1_000_003 * t + 101 * p + d)
            size = np.abs(r)
            best = np.argpartition(size, -2, axis=1)[:, -2:] if width > 1 else np.zeros((n, 2), np.int64)
            rows = np.arange(n)[:, None]
            swap = np.argsort(-size[rows, best], axis=1, kind="stable")
            best = best[rows, swap]
            top = size[rows, best]
            names[:, p] = 2 * best + (r[rows, best] < 0)
            loss[:, p] = top[:, 0] - top[:, 1]
        cost = loss @ choices.T
        order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        for q in range(probes):
            pick = choices[order[:, min(q, order.shape[1] - 1)]]
            code = np.full(n, t, np.int64)
            for p in range(parts):
                code = code * (2 * width) + np.take_along_axis(names[:, p], pick[:, p:p + 1], axis=1)[:, 0]
            out[:, t, q] = code
    return out


def sketches(x: np.ndarray) -> np.ndarray:
    """(rows, HEAD + 1) bytes of unit vectors: the first coordinates after a
    rotation in 127ths, and the length of the others in 255ths, rounded up."""
    n, d = x.shape
    padded = np.zeros((n, 1 << max(0, d - 1).bit_length()))
    padded[:, :d] = x
    z = rotate(padded, 1_000_000_007 + d)
    out = np.zeros((n, HEAD + 1), np.uint8)
    head = z[:, :HEAD]
    out[:, :head.shape[1]] = np.rint(head * 127).astype(np.int8).view(np.uint8)
    rest = np.sqrt((z[:, HEAD:] ** 2).sum(axis=1))
    out[:, HEAD] = np.minimum(255, np.ceil(rest * 255))
    return out


def reachable(sketch: np.ndarray, side: np.ndarray, threshold: float, diagonal: bool) -> np.ndarray:
    """Which of the nodes another one (``diagonal``) or one of the other side
    may reach: the product of the heads, that of the rests and the most that
    rounding took away are no less than the cosine."""
    head = sketch[:, :HEAD].view(np.int8).astype(np.float32) / np.float32(127)
    rest = sketch[:, HEAD].astype(np.float32) / np.float32(255)
    error = 0.5 * math.sqrt(HEAD) / 127
    least = threshold - error * (2 + error) - 1e-3
    left = np.arange(len(sketch)) if diagonal else np.flatnonzero(side == 0)
    right = left if diagonal else np.flatnonzero(side == 1)
    out = np.zeros(len(sketch), bool)
    for at in range(0, len(left), 512):
        rows = left[at:at + 512]
        near = head[rows] @ head[right].T + np.outer(rest[rows], rest[right]) >= least
        if diagonal:
            near[np.arange(len(rows)), rows] = False
        out[rows] |= near.any(axis=1)
        out[right] |= near.any(axis=0)
    return out


def unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def first_meeting(names: np.ndarray, a: np.ndarray, b: np.ndarray, bucket: int) -> np.ndarray:
    """Whether ``bucket`` is the smallest common name of the rows a and b.
    ``names``: (rows, tables, probes), names of one table only equal each other."""
    ok = np.ones(len(a), bool)
    for t in range(names.shape[1]):
        for p in range(names.shape[2]):
            x = names[a, t, p]
            for q in range(names.shape[2]):
                ok &= (x != names[b, t, q]) | (x >= bucket)
    return ok


def verify(bucket: int, node: np.ndarray, side: np.ndarray, copies: np.ndarray, x: np.ndarray,
           names: np.ndarray, threshold: float, diagonal: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links inside a block (``diagonal``) or between side 0 and side 1:
    per node its number of links that first meet here, and its local label."""
    if diagonal:
        left = right = np.arange(len(node))
    else:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    pairs_a, pairs_b = [], []
    for at in range(0, len(left), 512):
        rows = left[at:at + 512]
        i, j = np.nonzero(x[rows] @ x[right].T >= threshold - 1e-9)
        a, b = rows[i], right[j]
        keep = a < b if diagonal else np.ones(len(a), bool)
        pairs_a.append(a[keep])
        pairs_b.append(b[keep])
    a, b = np.concatenate(pairs_a or [left]), np.concatenate(pairs_b or [left])
    exact = (x[a] * x[b]).sum(axis=1) >= threshold
    a, b = a[exact], b[exact]
    label = local_labels(len(node), a, b)
    first = first_meeting(names, a, b, bucket)
    links = np.bincount(a[first], weights=copies[b[first]], minlength=len(node)) \
        + np.bincount(b[first], weights=copies[a[first]], minlength=len(node))
    return links.astype(np.int64), label


def dealt(posts: DataFrame, block: int) -> DataFrame:
    """``posts`` (bucket, node, ...) with ``cell``, every cell of a bucket
    whole and sorted in one task. A member of block m goes to the cells of
    the block pairs (i, j), i <= j, with i = m or j = m; a cell is i, j (31
    bits) and the side the member is on (a bit)."""
    crowded = (posts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
               .select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    found = posts.join(bounded_broadcast(settle(crowded)), "bucket", "left") \
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    m = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long")
    found = found.withColumn("m", m).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = (F.shiftleft(F.least("m", "other"), 32) + F.shiftleft(F.greatest("m", "other"), 1)
            + (F.col("m") > F.col("other")).cast("long"))
    return (found.withColumn("cell", cell).drop("m", "other", "blocks")
            .repartition("bucket", F.shiftright("cell", 1)).sortWithinPartitions("bucket", "cell"))


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int]]]]:
    """Sorted batches with the row ranges of their cells, each cell whole:
    the last one of a batch waits for the next batch."""
    held: list[pa.RecordBatch] = []

    def joined() -> tuple[pa.RecordBatch, list[int]]:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        bucket, cell = (batch.column(c).to_numpy() for c in ("bucket", "cell"))
        cut = (bucket[1:] != bucket[:-1]) | (cell[1:] >> 1 != cell[:-1] >> 1)
        return batch, [0, *(np.flatnonzero(cut) + 1).tolist(), batch.num_rows]
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        whole, at = joined()
        held = [whole.slice(at[-2])]
        if len(at) > 2:
            yield whole.slice(0, at[-2]), list(zip(at[:-2], at[1:-1]))
    if held:
        whole, at = joined()
        yield whole, list(zip(at[:-1], at[1:]))


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.95, tables: int = 12, probes: int = 3,
                           block: int = 2000, parts: int | None = None, id_col: str = "vec_id",
                           vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))

    def to_bytes(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for x in batch.column("v").to_pylist():
            a = np.array(x, "<f8") if x and None not in x else np.empty(0)
            out.append((a + 0.0).tobytes() if a.size and np.isfinite(a).all() and a.any() else None)
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "raw"])
    rows = map_batches(rows, to_bytes, "vec_id long, raw binary")
    nodes = settle(rows.where(F.col("raw").isNotNull()).groupBy("raw")
                        .agg(F.count(F.lit(1)).alias("copies"),
                             F.min(F.coalesce("vec_id", F.lit(NULL_ID))).alias("low"))
                        .withColumn("node", F.monotonically_increasing_id()))
    if parts is None:
        shape = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("raw")).alias("bytes")).first()
        width = max(2, 2 * ((shape["bytes"] or 8) // 8))
        parts = max(1, round(math.log(max(2, shape["n"])) / math.log(width)))

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column("raw").to_pylist()
        names = np.empty((len(raw), tables * probes), np.int64)
        sketch = np.empty((len(raw), HEAD + 1), np.uint8)
        by_length: dict[int, list[int]] = {}
        for i, r in enumerate(raw):
            by_length.setdefault(len(r), []).append(i)
        for size, at in by_length.items():
            x = unit([raw[i] for i in at])
            # Vectors of different lengths never meet: mix the length in.
            names[at] = (bucket_names(x, tables, parts, probes) * np.int64(0x9E3779B97F4A7C1)
                         + np.int64(size)).reshape(len(at), -1)
            sketch[at] = sketches(x)
        return pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("copies"), batch.column("raw"),
             pa.array([s.tobytes() for s in sketch], pa.binary()),
             pa.array(names.tolist(), pa.list_(pa.int64()))], ["node", "copies", "raw", "sketch", "names"])
    named = settle(map_batches(nodes.select("node", "copies", "raw"), hashed,
                               "node long, copies long, raw binary, sketch binary, names array<long>"))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ranges in cells(batches):
            sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, HEAD + 1)
            cell = batch.column("cell").to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for a, b in ranges:
                if b - a > 1:
                    first = int(cell[a])
                    keep[a:b] = reachable(sketch[a:b], cell[a:b] & 1, threshold,
                                          first >> 32 == (first >> 1) % (1 << 31))
            yield batch.select(["node", "bucket"]).filter(pa.array(keep))
    posts = named.select("node", "sketch", F.explode(F.array_distinct("names")).alias("bucket"))
    left = settle(map_stream(dealt(posts, block), narrow, "node long, bucket long")
                  .groupBy("node").agg(F.collect_set("bucket").alias("buckets")))
    posts = named.drop("sketch").join(left, "node").withColumn("bucket", F.explode("buckets")).drop("buckets")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ranges in cells(batches):
            raw = batch.column("raw").to_pylist()
            nodes_, copies, cell, bucket = (batch.column(c).to_numpy() for c in ("node", "copies", "cell", "bucket"))
            names = batch.column("names").flatten().to_numpy().reshape(-1, tables, probes)
            told = []
            for a, b in ranges:
                by_length: dict[int, list[int]] = {}
                for i in range(a, b):
                    by_length.setdefault(len(raw[i]), []).append(i)
                for part in by_length.values():
                    at, first = np.array(part), int(cell[a])
                    links, label = verify(int(bucket[a]), nodes_[at], cell[at] & 1, copies[at],
                                          unit([raw[i] for i in part]), names[at], threshold,
                                          first >> 32 == (first >> 1) % (1 << 31))
                    some = (links > 0) | (label != np.arange(len(part)))
                    told.append((nodes_[at][some], nodes_[at][label][some], links[some]))
            if told:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*told)],
                                                 ["node", "other", "links"])
    found = settle(map_stream(dealt(posts, block), match, "node long, other long, links long")
                        .groupBy("node", "other").agg(F.sum("links").alias("links")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(found.select("node", "other").where("node != other"))
    member = nodes.join(label.withColumnRenamed("id", "node"), "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    low = settle(member.groupBy("component").agg(F.min("low").alias("component_low")))
    placed = (member.join(low, "component").join(links, "node", "left")
              .select("raw", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_low"))
    own = F.coalesce("vec_id", F.lit(NULL_ID))
    out = rows.join(settle(placed), "raw", "left").withColumn("component_id", F.coalesce("component_low", own))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("component_id") != NULL_ID, F.col("component_id")).alias("component_id"),
                      (F.col("component_id") == own).alias("kept"))
