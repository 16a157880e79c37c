"""Best-fit packing with Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens, and the pieces go
into as few sequences as can be found. Only the lengths matter, so the
instance is the histogram of lengths: at most ``capacity`` numbers, however
many pieces there are. It is solved on the driver, which never sees a piece:

1. Reduction: for a length (largest first), a set of at most three pieces
   that provably dominates every other feasible set with that length is
   fixed for as many sequences as its pieces allow. A set dominates another
   if the other's pieces can be put, without overlap, into its pieces.
2. The rest is packed best-fit decreasing, many equal pieces at a time.

The solution is a list of runs: "pieces rank a.. of the order by length go
into sequences s.., q to a sequence, from offset o". Every piece gets its
global rank (`global_row_index`: range partitions, so a length that a third
of all pieces share spans many tasks) and looks its run up.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed each; null ids are packed like others; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import global_row_index
from .common import map_batches, texts
from .tokens import default_vocabulary, encoder


@dataclass
class Plan:
    """Runs in the order of the pieces sorted by falling length: run i holds
    the pieces with ranks ``rank[i]`` up to ``rank[i + 1]``."""
    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    per_sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    sequences: int = 0
    fixed: int = 0


def dominating_set(counts: np.ndarray, j: int, capacity: int) -> tuple[int, ...] | None:
    """Lengths of a set with ``j`` that dominates all feasible sets with
    ``j``, or None. ``counts[x]``: pieces of length x, ``j`` among them."""
    counts[j] -= 1
    try:
        present = np.flatnonzero(counts)
        room = capacity - j
        if not len(present) or present[0] > room:
            return (j,)
        k = int(present[np.searchsorted(present, room, "right") - 1])
        if k == room:
            return j, k
        small = []  # the three smallest pieces left
        for x in present[:3].tolist():
            small += [x] * int(min(3, counts[x]))
        small = small[:3]
        if len(small) < 2 or small[0] + small[1] > room:
            return j, k  # one more piece at most: the largest that fits
        if len(small) == 3 and sum(small) <= room:
            return None
        # Two more pieces at most. Largest partner of each length in a pair:
        fit = present[present <= room]
        limit = np.searchsorted(present, room - fit, "right") - 1
        ok = limit >= 0
        fit, mate = fit[ok], present[limit[ok]]
        alone = (fit == mate) & (counts[fit] < 2)
        lower = np.maximum(np.searchsorted(present, mate) - 1, 0)
        mate = np.where(alone, np.where(present[lower] < fit, present[lower], 0), mate)
        fit, mate = fit[mate > 0], mate[mate > 0]
        if not len(fit) or k >= int((fit + mate).max()):
            return j, k  # k holds any pair
        counts[k] -= 1
        rest = np.flatnonzero(counts)
        counts[k] += 1
        at = np.searchsorted(rest, room - k, "right") - 1
        if at >= 0 and int(rest[at]) >= int(np.minimum(fit, mate).max()):
            return j, k, int(rest[at])  # as large, one by one, as any pair
        return None
    finally:
        counts[j] += 1


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Pack ``histogram`` (length -> pieces) into sequences of ``capacity``."""
    counts = np.zeros(capacity + 1, np.int64)
    for x, n in histogram.items():
        counts[x] = n
    first = np.concatenate((np.cumsum(counts[::-1])[::-1][1:], [0]))  # rank of a length's first piece
    used = np.zeros(capacity + 1, np.int64)
    p = Plan()

    def put(x: int, sequence: int, times: int, per: int, offset: int) -> None:
        p.length.append(x)
        p.rank.append(int(first[x] + used[x]))
        p.sequence.append(sequence)
        p.per_sequence.append(per)
        p.offset.append(offset)
        used[x] += times * per
        counts[x] -= times * per

    changed = True
    while changed:
        changed = False
        for j in np.flatnonzero(counts)[::-1].tolist():
            while counts[j]:
                found = dominating_set(counts, j, capacity)
                if not found:
                    break
                times = min(int(counts[x]) // found.count(x) for x in set(found))
                offset = 0
                for x in dict.fromkeys(found):
                    put(x, p.sequences, times, found.count(x), offset)
                    offset += x * found.count(x)
                p.sequences += times
                p.fixed += times
                changed = True

    open_by_room: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, sequences)
    has_room = np.zeros(capacity + 1, bool)

    def add(room: int, sequence: int, n: int) -> None:
        if n and room:
            open_by_room.setdefault(room, []).append((sequence, n))
            has_room[room] = True

    for x in np.flatnonzero(counts)[::-1].tolist():
        while n := int(counts[x]):
            at = int(has_room[x:].argmax()) + x
            if has_room[at]:
                sequence, size = open_by_room[at].pop()
                has_room[at] = bool(open_by_room[at])
            else:
                at, sequence, size = capacity, p.sequences, -(-n // (capacity // x))
                p.sequences += size
            per = at // x
            full = min(size, n // per)
            if full:
                put(x, sequence, full, per, capacity - at)
                add(at - per * x, sequence, full)
            if full < size:
                left = n - full * per
                if left:  # fewer than a sequence would take
                    put(x, sequence + full, 1, left, capacity - at)
                    add(at - left * x, sequence + full, 1)
                    full += 1
                add(at, sequence + full, size - full)
    order = np.argsort(np.array(p.rank, np.int64), kind="stable")
    for name in ("length", "rank", "sequence", "per_sequence", "offset"):
        setattr(p, name, np.array(getattr(p, name), np.int64)[order])
    return p


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: the ids of every text and the
    end id, longer ones cut after every ``capacity`` ids; ``ids`` is binary
    (little-endian uint32)."""
    vocabulary = vocabulary or default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(vocabulary)
        doc_ids, piece, start, length, ids = [], [], [], [], []
        for doc_id, b in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text").to_pylist())):
            b += end
            for k, at in enumerate(range(0, len(b), 4 * capacity)):
                part = b[at:at + 4 * capacity]
                doc_ids.append(doc_id)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                ids.append(part)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
            ["doc_id", "piece", "start", "length", "ids"])
    return map_batches(texts(docs), cut, "doc_id long, piece int, start long, length long, ids binary")


def place(lengths: DataFrame, capacity: int = 4096) -> DataFrame:
    """Give every row of ``lengths`` (a column ``length`` from 1 to
    ``capacity``) a ``sequence_id`` and an ``offset``."""
    # Kept while they are ranked: finding the ranges reads the rows once
    # more, and they may be costly to make. The ranked rows are checkpointed.
    kept = lengths.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ranked = global_row_index(kept, [F.desc("length")], "_rank")
    finally:
        kept.unpersist()
    histogram = {r["length"]: r["n"] for r in  # at most ``capacity`` rows
                 ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(histogram, capacity)
    names = [f.name for f in lengths.schema.fields]

    def look_up(batch: pa.RecordBatch) -> pa.RecordBatch:
        rank = batch.column("_rank").to_numpy()
        run = np.searchsorted(runs.rank, rank, "right") - 1
        nth = rank - runs.rank[run]
        sequence, slot = np.divmod(nth, runs.per_sequence[run])
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in names], pa.array(runs.sequence[run] + sequence),
             pa.array(runs.offset[run] + slot * runs.length[run])],
            [*names, "sequence_id", "offset"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lengths.schema.fields)
    return map_batches(ranked, look_up, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per
    piece. The ids themselves are not moved: whoever writes a sequence cuts
    them from the document by ``start`` and ``length``."""
    cut = pieces(docs, vocabulary, capacity, end_id)
    return place(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)
