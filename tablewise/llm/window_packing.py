"""Packing into windows, best fit decreasing, with a segment tree.

1. A document's ids and its end id are cut into full windows of ``capacity``
   tokens; what remains of it is one shorter piece.
2. The pieces are packed best fit decreasing: a segment tree whose leaves are
   the remaining capacities finds the tightest open window for each. Only
   lengths matter, so equal pieces are placed many at a time, and what the
   driver handles is the histogram of lengths: at most ``capacity`` numbers.
3. A window that is full, or filled to a power of two (such a sequence is not
   padded), or short of at most ``slack`` tokens stays as it is. Of the
   others the emptiest are dissolved, and their pieces, cut where a window
   ends, fill the gaps of the rest: as few windows as possible are dissolved,
   so few documents are cut. What is left over, less than a window, becomes
   sequences of powers of two. With ``slack`` 0 nothing is padded.

The plan is a bounded list of runs ("the pieces of rank a.. by falling length
go into windows s.., q to a window, from offset o"). Every piece gets its
global rank (range partitions, so a length that a third of all pieces share
spans many tasks), looks its run up and is cut by arithmetic. Only documents
that are cut in step 3 are encoded again, found by the SHA-256 of their text,
each distinct text once.

Defined cases: a null or empty text is the end id alone; a text of any length
is packed whole; repeated rows are packed each; null ids are packed like
others; pieces of equal length go in any order; an empty table gives no rows;
other columns of ``docs`` are left behind, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.broadcast import bounded_broadcast
from ..plans.ranking import global_row_index
from .byte_tokens import default_vocabulary, encoder
from .common import map_batches, settle, texts


class OpenWindows:
    """Open windows by remaining capacity: runs (first window, windows) at
    the leaves of a segment tree that counts the runs below each node."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()  # more than capacity
        self.count = [0] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, room: int, first: int, windows: int) -> None:
        if room and windows:
            self.runs.setdefault(room, []).append((first, windows))
            self._change(room, 1)

    def tightest(self, size: int) -> int | None:
        """The smallest remaining capacity of at least ``size``."""
        node = size + self.leaves
        if self.count[node]:
            return size
        while node > 1:  # up to the first right sibling with windows, then down its left side
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None

    def take(self, room: int) -> tuple[int, int]:
        self._change(room, -1)
        return self.runs[room].pop()


@dataclass
class Plan:
    """Runs by rank (``runs``: length, first rank, first window, pieces to a
    window, offset), the windows to dissolve (``donors``: first window,
    windows, fill, place of its first token among the tokens to move) and the
    gaps they fill (``gaps``: the same, with the gap's size and its offset)."""
    runs: np.ndarray
    donors: np.ndarray
    gaps: np.ndarray
    windows: int


def best_fit(histogram: dict[int, int], capacity: int) -> tuple[list[tuple], list[tuple[int, int, int]], int]:
    """(runs, open windows as (room, first, windows), number of windows)."""
    opened, runs, windows, rank = OpenWindows(capacity), [], 0, 0
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            room = opened.tightest(size)
            if room is None:
                room, first, n = capacity, windows, -(-left // (capacity // size))
                windows += n
            else:
                first, n = opened.take(room)
            # A window that took one piece is the tightest for the next, as
            # long as it has room.
            per = room // size
            full = min(n, left // per)
            rest = left - full * per if full < n else 0
            for count, at, q in ((full, first, per), (min(rest, 1), first + full, rest)):
                if count:
                    runs.append((size, rank, at, q, capacity - room))
                    rank += count * q
                    left -= count * q
                    opened.add(room - q * size, at, count)
            used = full + min(rest, 1)
            opened.add(room, first + used, n - used)
    return runs, [(room, *run) for room, some in opened.runs.items() for run in some], windows


def plan(histogram: dict[int, int], capacity: int, slack: int = 0) -> Plan:
    runs, opened, windows = best_fit(histogram, capacity)
    short = sorted((capacity - room, first, n) for room, first, n in opened
                   if room > slack and (capacity - room) & (capacity - room - 1))
    missing = sum((capacity - fill) * n for fill, _, n in short)
    dissolve = -(-missing // capacity)  # each gives its fill and needs no filling: a capacity of both
    donors, gaps, moved, filled = [], [], 0, 0
    for fill, first, n in short:
        d = min(n, dissolve)
        dissolve -= d
        if d:
            donors.append((first, d, fill, moved))
            moved += d * fill
        if n > d:
            gaps.append((first + d, n - d, capacity - fill, filled, fill))
            filled += (n - d) * (capacity - fill)
    while filled < moved:  # less than a window is left over
        part = 1 << (moved - filled).bit_length() - 1
        gaps.append((windows, 1, part, filled, 0))
        windows += 1
        filled += part

    def table(rows, width):
        return np.array(rows, np.int64).reshape(-1, width)
    return Plan(table(runs, 5), table(sorted(donors), 4), table(gaps, 5), windows)


def located(p: Plan, rank: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    """(piece, from, tokens, window, offset): where the tokens of the pieces
    of the given ranks and lengths go, in parts if they move."""
    run = np.searchsorted(p.runs[:, 1], rank, "right") - 1
    nth = rank - p.runs[run, 1]
    window, slot = np.divmod(nth, p.runs[run, 3])
    window, offset = p.runs[run, 2] + window, p.runs[run, 4] + slot * p.runs[run, 0]
    piece = np.arange(len(rank))
    if not len(p.donors):
        return piece, np.zeros(len(rank), np.int64), length, window, offset
    donor = np.maximum(np.searchsorted(p.donors[:, 0], window, "right") - 1, 0)
    back = window - p.donors[donor, 0]
    moves = (back >= 0) & (back < p.donors[donor, 1])
    parts = [(piece[~moves], np.zeros((~moves).sum(), np.int64), length[~moves], window[~moves], offset[~moves])]
    which = piece[moves]
    at = (p.donors[donor, 3] + back * p.donors[donor, 2] + offset)[moves]  # place among the tokens to move
    done = np.zeros(len(which), np.int64)
    while len(which):
        gap = np.searchsorted(p.gaps[:, 3], at, "right") - 1
        n, into = np.divmod(at - p.gaps[gap, 3], p.gaps[gap, 2])
        size = np.minimum(length[which] - done, p.gaps[gap, 2] - into)
        parts.append((which, done, size, p.gaps[gap, 0] + n, p.gaps[gap, 4] + into))
        more = done + size < length[which]
        which, at, done = which[more], (at + size)[more], (done + size)[more]
    return tuple(np.concatenate(c) for c in zip(*parts))


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """``(doc_id, text_key, start, length, ids_crc32, doc_tokens)``: the full
    windows and the remaining piece of every document; ``text_key`` (SHA-256
    of the text) for pieces shorter than a window only."""
    vocabulary = vocabulary or default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column("text").to_pylist()
        rows = []
        for doc_id, text, ids in zip(batch.column("doc_id").to_pylist(), raw, encoder(vocabulary).encode(raw)):
            ids += end
            for at in range(0, len(ids), 4 * capacity):
                part = ids[at:at + 4 * capacity]
                key = hashlib.sha256(text).digest() if len(part) < 4 * capacity else None
                rows.append((doc_id, key, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4))
        types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)],
            ["doc_id", "text_key", "start", "length", "ids_crc32", "doc_tokens"])
    return map_batches(texts(docs), cut, "doc_id long, text_key binary, start long, length long, ids_crc32 long, "
                                         "doc_tokens long")


def place(cut: DataFrame, capacity: int = 1024, slack: int = 0) -> DataFrame:
    """The rows of `pieces` in parts with ``sequence_id`` and ``offset``;
    ``ids_crc32`` is null where a piece is in several parts."""
    # Kept while they are ranked: finding the ranges reads the rows once more.
    kept = cut.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ranked = global_row_index(kept, [F.desc("length")], "_rank")
    finally:
        kept.unpersist()
    histogram = {r["length"]: r["n"] for r in  # at most ``capacity`` rows
                 ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    p = plan(histogram, capacity, slack)

    def look_up(batch: pa.RecordBatch) -> pa.RecordBatch:
        length = batch.column("length").to_numpy()
        piece, begin, size, window, offset = located(p, batch.column("_rank").to_numpy(), length)
        whole = size == length[piece]
        part = batch.take(pa.array(piece))
        crc = pa.array(part.column("ids_crc32").to_numpy(zero_copy_only=False), pa.int64(), mask=~whole)
        start = pa.array(part.column("start").to_numpy(zero_copy_only=False) + begin)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_key"), start, pa.array(size), crc, part.column("doc_tokens"),
             pa.array(window), pa.array(offset)],
            ["doc_id", "text_key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return map_batches(ranked, look_up, "doc_id long, text_key binary, start long, length long, ids_crc32 long, "
                                        "doc_tokens long, sequence_id long, offset long")


def part_checksums(docs: DataFrame, parts: DataFrame, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """``(text_key, start, length, part_crc32)`` of the parts named in
    ``parts`` (text_key, start, length): their texts are encoded once more."""
    vocabulary = vocabulary or default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()
    # A text of at most ``capacity`` tokens has a bounded number of different parts, however many rows hold it.
    wanted = settle(parts.select("text_key", "start", "length").distinct()
                    .groupBy("text_key").agg(F.collect_list(F.struct("start", "length")).alias("parts")))
    found = (texts(docs).select(F.unhex(F.sha2("text", 256)).alias("text_key"), "text")
             .join(bounded_broadcast(wanted.select("text_key")), "text_key", "left_semi")
             .dropDuplicates(["text_key"]).join(wanted, "text_key"))

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for key, ids, some in zip(batch.column("text_key").to_pylist(),
                                  encoder(vocabulary).encode(batch.column("text").to_pylist()),
                                  batch.column("parts").to_pylist()):
            ids += end
            rows += [(key, s["start"], s["length"], zlib.crc32(ids[4 * s["start"]:4 * (s["start"] + s["length"])]))
                     for s in some]
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, types)],
                                          ["text_key", "start", "length", "part_crc32"])
    return map_batches(found.select("text_key", "text", "parts"), check,
                       "text_key binary, start long, length long, part_crc32 long")


def pack_windows(docs: DataFrame, vocabulary: str | None = None, capacity: int = 1024, end_id: int = 0,
                 slack: int = 0) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``
    per piece. The ids themselves are not moved: whoever writes a sequence
    cuts them from the document by ``start`` and ``length``."""
    placed = place(pieces(docs, vocabulary, capacity, end_id), capacity, slack)
    parts = settle(placed.where("ids_crc32 IS NULL"))
    sums = settle(part_checksums(docs, parts, vocabulary, end_id))
    mended = (parts.drop("ids_crc32").join(bounded_broadcast(sums), ["text_key", "start", "length"])
              .withColumnRenamed("part_crc32", "ids_crc32"))
    return placed.where("ids_crc32 IS NOT NULL").unionByName(mended).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
