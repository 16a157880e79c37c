"""Suffix-array dedup by a depth-limited radix sort of suffixes.

Only suffixes that share their first ``length`` bytes matter, so the suffixes
are sorted most significant digit first and no deeper than ``length`` bytes;
a suffix alone in its group is dropped after each pass, and the groups that
are left at full depth are exactly the repeated windows.

First digit. A suffix' first digit is the hash of the smallest (by hash)
``gram``-byte string inside its window, a function of the window alone.
Neighbouring suffixes mostly share that string, so they travel as one
segment, about 70 suffixes to a row instead of one row each:

1. Count the segments per digit (a partial aggregate). A digit that occurs
   once holds no repeated window. If all segments of a digit are equal (by a
   second hash), all their windows are repeated.
2. Of the other digits, each distinct segment is fetched once with its bytes
   and parted by its second digit: the bytes beside the anchor, on the side
   where the window holds more of them (at most two parts a segment). Tasks
   sort the suffixes of a group by further digits of a quarter of the window
   each, dropping lone suffixes after each pass.
3. The repeated windows go back to all places of their segments, are merged
   per text and cut out.

Where a first digit has more than ``run`` distinct segments, the second digit
is a pass over the cluster too: parts are counted by it and lone ones are
dropped before any sort. What still has more than ``run`` equal second digits
is sorted in several runs, dealt by a hash, and the runs are merged: each
sends the windows it holds once and one of every window it holds more often,
and an aggregate finds those that two runs share. So no task sorts more than
about ``run`` segments of one digit. Digits are compared as 64-bit hashes of
their bytes.

Windows are judged on the input; every occurrence goes, the first included;
matches never cross texts. Defined cases: null texts are empty; texts shorter
than ``length`` stay; very long texts are handled whole, in blocks of window
starts; of equal strings none is preferred, so ties do not arise; rows equal
in id and text are copies of each other and lose all their windows; null ids
are ids of their own; other columns travel inside a struct, so their names
cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ..plans.broadcast import bounded_broadcast
from .common import NULL_ID, map_batches, map_stream, settle
from .hashing import BASE, CHUNK, mixed, powers, prefix_hashes, span_hash

PLACE_BITS = 21
DIGITS = 4


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:span - width], x[width - span:]) if span < width else x


def segments(text: bytes, length: int) -> tuple[np.ndarray, ...]:
    """The text's window starts as runs that share their smallest gram:
    (digit, hash of the run's bytes, first start, number of starts, gram's
    place after the first start)."""
    gram = max(1, length * 3 // 10)
    parts = []
    for at in range(0, len(text) - length + 1, CHUNK):  # window starts handled at once
        buf = np.frombuffer(text, np.uint8, min(CHUNK + length - 1, len(text) - at), at)
        p = prefix_hashes(buf)
        n = len(buf) - gram + 1
        place = np.arange(n)
        h = span_hash(p, place, place + gram)
        # Smallest hash, leftmost if equal: the low bits hold the place.
        low = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | place.astype(np.uint64)
        best = (sliding_min(low, length - gram + 1) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        start = np.concatenate(([0], np.flatnonzero(best[1:] != best[:-1]) + 1))
        count = np.diff(np.append(start, len(best)))
        off = best[start] - start
        whole = span_hash(p, start, start + count + (length - 1))
        whole = mixed(whole + count.astype(np.uint64) * np.uint64(BASE) + off.astype(np.uint64))
        parts.append((h[best[start]].view(np.int64), whole.view(np.int64), start + at, count, off))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*parts))


def repeated_windows(group: np.ndarray, size: np.ndarray, count: np.ndarray, off: np.ndarray,
                     data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes of segments. Segment i has the digit ``group[i]``,
    ``count[i]`` suffixes and the bytes of its place in ``data`` (sizes in
    ``size``). Returns, suffix after suffix, whether its window occurs in
    another segment of the same digit, and whether it is the first of such
    equal ones."""
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    out, first_one = np.zeros(len(owner), bool), np.zeros(len(owner), bool)
    buf = np.frombuffer(data, np.uint8)
    p = np.concatenate([prefix_hashes(buf[a:a + s]) for a, s in zip(first, size)])
    base = first + np.arange(len(first))  # each segment has one prefix value more than bytes
    live = np.arange(len(owner))
    # Equal windows have their gram at the same place: the second digit.
    key = mixed(group.view(np.uint64))[owner] + (off[owner] - nth).astype(np.uint64) * np.uint64(BASE)
    cuts = np.linspace(0, length, DIGITS + 1).astype(np.int64)
    for d in range(-1, DIGITS):
        if d >= 0:
            o, s = owner[live], nth[live] + cuts[d]
            e = s + (cuts[d + 1] - cuts[d])
            digit = mixed((p[base[o] + e] - p[base[o] + s]) * powers(True, length + CHUNK)[s])
            key = mixed(key) * np.uint64(BASE) + digit
        order = np.argsort(key, kind="stable")
        k = key[order]
        new = np.concatenate(([True], k[1:] != k[:-1]))
        lone = new & np.concatenate((new[1:], [True]))
        keep = np.sort(order[~lone])
        live, key = live[keep], key[keep]
        if not len(live):
            break
    out[live] = True
    first_one[live[np.unique(key, return_index=True)[1]]] = True
    return out, first_one


def runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[::2].tolist(), edge[1::2].tolist()


def whole_groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows or more that never part equal values of
    ``deal``, by which the input is sorted."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if n >= rows:
            last = held[-1].column("deal")[-1].as_py()
            deal = batch.column("deal").to_numpy()
            same = int((deal == last).argmin()) if deal[-1] != last else len(deal)
            held.append(batch.slice(0, same))
            if same == len(deal):
                n += same
                continue
            yield pa.Table.from_batches(held)
            held, n, batch = [], 0, batch.slice(same)
        held.append(batch)
        n += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


SEGMENT = "digit long, whole long"
PLACE = "kid long, ksum long, first int, count int, off int"


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a key without nulls."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("kid"),
                       F.xxhash64(text).alias("ksum"), text.alias("text"))


def _digits(texts: DataFrame, length: int, places: bool) -> DataFrame:
    """The segments of every text, with their places if asked for."""
    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, rows = [], []
        for i, t in enumerate(batch.column("text").to_pylist()):
            s = segments(t, length)
            if len(s[0]):
                parts.append(s)
                rows.append(np.full(len(s[0]), i))
        digit, whole, first, count, off = (np.concatenate(x) for x in zip(*parts)) if parts else \
            (np.empty(0, np.int64) for _ in range(5))
        out = [pa.array(digit), pa.array(whole)]
        if not places:
            return pa.RecordBatch.from_arrays(out, ["digit", "whole"])
        at = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64))
        out += [batch.column("kid").take(at), batch.column("ksum").take(at),
                *(pa.array(x.astype(np.int32)) for x in (first, count, off))]
        return pa.RecordBatch.from_arrays(out, ["digit", "whole", "kid", "ksum", "first", "count", "off"])
    source = texts.select("kid", "ksum", "text").where(F.length("text") >= length)
    return map_batches(source if places else source.select("text"), cut,
                       f"{SEGMENT}, {PLACE}" if places else SEGMENT)


PART = "second long, many boolean, nth int, count int, off int, data binary"
OPEN = "array<struct<nth: int, x: bigint, y: bigint, once: boolean>>"


def parted(digit: int, count: int, off: int, data: bytes, length: int) -> Iterator[tuple[int, int, int]]:
    """A segment's parts by second digit: (second digit, first suffix, number
    of suffixes). A window with its anchor in its first half (or middle) is
    known by the bytes after the anchor, another by those before it."""
    gram = max(1, length * 3 // 10)
    half = (length - gram) // 2
    left = max(0, min(count, off - half))  # windows that hold more bytes before the anchor
    seed = digit & ((1 << 63) - 1)
    if left:
        yield xxh3_64_intdigest(data[off - half:off + gram], seed) - (1 << 63), 0, left
    if left < count:
        yield xxh3_64_intdigest(data[off:off + gram + half], seed + 1) - (1 << 63), left, count - left


def _fetch(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` segments with their bytes, parted by second digit."""
    per_text = wanted.groupBy("kid", "ksum").agg(F.collect_list(F.struct(
        "digit", "whole", "first", "count", "off", (F.col("n") > 1).alias("many"))).alias("segments"))

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(8)]
        for text, found in zip(batch.column("text").to_pylist(), batch.column("segments").to_pylist()):
            for s in found:
                data = text[s["first"]:s["first"] + s["count"] + length - 1]
                for second, nth, count in parted(s["digit"], s["count"], s["off"], data, length):
                    for column, x in zip(out, (s["digit"], s["whole"], second, s["many"], nth, count, s["off"] - nth,
                                               data[nth:nth + count + length - 1])):
                        column.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)],
                                          ["digit", "whole", "second", "many", "nth", "count", "off", "data"])
    # Rows equal in id and text are one text here.
    joined = texts.select("kid", "ksum", "text").join(per_text, ["kid", "ksum"]).select("text", "segments")
    return map_batches(joined, read, f"{SEGMENT}, {PART}")


def _sorted_runs(parts: DataFrame, length: int, rows: int) -> DataFrame:
    """``(digit, whole, second, ranges, open)`` of parts dealt by ``deal``:
    runs [a, b) of repeated windows, and for groups of several runs the
    windows to merge (hashes, and whether the run holds the window once)."""
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, rows):
            second, many, several = (table.column(c).to_numpy() for c in ("second", "many", "several"))
            count, nth = (table.column(c).to_numpy().astype(np.int64) for c in ("count", "nth"))
            data = table.column("data").to_pylist()
            flags, first_one = repeated_windows(second, np.array([len(x) for x in data]), count,
                                                table.column("off").to_numpy().astype(np.int64), b"".join(data), length)
            ends = np.cumsum(count)
            # Segments that occur more than once are repeated as a whole anyway.
            told = np.unique(np.searchsorted(ends, np.flatnonzero(flags), "right"))
            keep, ranges, windows = np.union1d(told[~many[told]], np.flatnonzero(several)), [], []
            for i in keep.tolist():
                mine = slice(ends[i] - count[i], ends[i])
                ranges.append([] if many[i] else [{"a": a + nth[i], "b": b + nth[i]} for a, b in zip(*runs(flags[mine]))])
                if not several[i]:
                    windows.append([])
                    continue
                at = np.flatnonzero(~flags[mine] | first_one[mine])
                p = prefix_hashes(np.frombuffer(data[i], np.uint8))
                x, y = (span_hash(p, a, b).view(np.int64).tolist()
                        for a, b in ((at, at + length // 2), (at + length // 2, at + length)))
                once = (~flags[mine][at] & ~many[i]).tolist()
                windows.append([{"nth": n, "x": u, "y": v, "once": o}
                                for n, u, v, o in zip((at + nth[i]).tolist(), x, y, once)])
            kinds = (pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])),
                     pa.list_(pa.struct([("nth", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("once", pa.bool_())])))
            yield pa.RecordBatch.from_arrays(
                [table.column(c).combine_chunks().take(pa.array(keep)) for c in ("digit", "whole", "second")]
                + [pa.array(x, k) for x, k in zip((ranges, windows), kinds)],
                ["digit", "whole", "second", "ranges", "open"])
    dealt = parts.repartition("deal").sortWithinPartitions("deal")
    return map_stream(dealt, sort, f"{SEGMENT}, second long, ranges array<struct<a: int, b: int>>, open {OPEN}")


def _repeated_ranges(texts: DataFrame, kinds: DataFrame, length: int, run: int) -> DataFrame:
    """``(digit, whole, ranges)`` of the windows that distinct segments share."""
    crowded = settle(kinds.groupBy("digit").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > run).select("digit"))
    parts = _fetch(texts, kinds, length)
    cold = lambda rows: rows.select("*", F.col("second").alias("deal"), F.lit(False).alias("several"))
    if crowded.isEmpty():
        return _sorted_runs(cold(parts), length, run).where(F.size("ranges") > 0).select("digit", "whole", "ranges")
    parts, few = settle(parts), bounded_broadcast(crowded)
    hot = parts.join(few, "digit")
    sizes = settle(hot.groupBy("second").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
                   .select("second", F.ceil(F.col("m") / run).alias("runs")))
    split = hot.join(sizes, "second").select(
        *hot.columns, F.xxhash64("second", F.pmod(F.col("whole"), F.col("runs"))).alias("deal"),
        (F.col("runs") > 1).alias("several"))
    found = settle(_sorted_runs(cold(parts.join(few, "digit", "left_anti")).unionByName(split), length, run))
    window = found.select("digit", "whole", "second", F.explode("open").alias("w")).select(
        "digit", "whole", "second", "w.*")
    shared = (window.groupBy("second", "x", "y").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
              .select("second", "x", "y"))
    merged_runs = (window.where("once").join(shared, ["second", "x", "y"])
                   .groupBy("digit", "whole").agg(F.collect_list(
                       F.struct(F.col("nth").alias("a"), (F.col("nth") + 1).alias("b"))).alias("ranges")))
    return found.where(F.size("ranges") > 0).select("digit", "whole", "ranges").unionByName(merged_runs)


def repeated_spans(texts: DataFrame, length: int, run: int) -> DataFrame:
    """``(kid, ksum, spans)``: byte ranges covered by repeated windows, as
    they were found (they may overlap)."""
    digits = settle(_digits(texts, length, False).groupBy("digit")
                         .agg(F.min("whole").alias("lo"), F.max("whole").alias("hi"), F.count(F.lit(1)).alias("n"))
                         .where("n > 1").select("digit", (F.col("lo") == F.col("hi")).alias("equal")))
    places = settle(_digits(texts, length, True).join(digits, "digit"))
    unequal = places.where(~F.col("equal"))
    kinds = settle(unequal.groupBy("digit", "whole")
                        .agg(F.min(F.struct("kid", "ksum", "first", "count", "off")).alias("p"),
                             F.count(F.lit(1)).alias("n"))
                        .select("digit", "whole", "p.*", "n"))
    # A segment that occurs more than once is repeated as a whole.
    everything = F.array(F.struct(F.lit(0).alias("a"), F.col("count").alias("b")))
    ranges = settle(kinds.where("n > 1").select("digit", "whole", everything.alias("ranges"))
                    .unionByName(_repeated_ranges(texts, kinds, length, run)))
    span = lambda a, b: F.struct((F.col("first") + a).alias("start"),
                                 (F.col("first") + b + (length - 1)).alias("end"))
    equal = places.where("equal").select("kid", "ksum", span(F.lit(0), F.col("count")).alias("span"))
    other = (unequal.join(ranges, ["digit", "whole"])
             .select("kid", "ksum", "first", F.explode("ranges").alias("r"))
             .select("kid", "ksum", span(F.col("r.a"), F.col("r.b")).alias("span")))
    return equal.union(other).groupBy("kid", "ksum").agg(F.collect_list("span").alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = 200, run: int = 2_000, decoded: bool = False) -> DataFrame:
    """Columns of ``docs`` but text as a struct ``row``; ``kept``, the bytes
    that are left (``decoded``: as a string, without what is left of
    characters that were cut through); ``n_bytes`` of the whole text;
    ``removed``, the maximal removed byte ranges."""
    texts = _keyed(docs)
    found = texts.join(repeated_spans(texts, length, run), ["kid", "ksum"], "left")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, sizes, removed = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            gone = merged(spans)
            at, parts = 0, []
            for a, b in gone:
                parts.append(text[at:a])
                at = b
            kept.append(b"".join(parts) + text[at:] if gone else text)
            sizes.append(len(text))
            removed.append([{"start": a, "end": b} for a, b in gone])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        left = pa.array([b.decode("utf-8", "ignore") for b in kept], pa.string()) if decoded else pa.array(kept, pa.binary())
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), left, pa.array(sizes, pa.int64()), pa.array(removed, kind)],
            ["row", "kept", "n_bytes", "removed"])
    row = texts.schema["row"].dataType.simpleString()
    return map_batches(found.select("row", "text", "spans"), cut, f"row {row}, kept {'string' if decoded else 'binary'}, "
                       "n_bytes long, removed array<struct<start: int, end: int>>")


def without_repeats(docs: DataFrame, length: int = 200, run: int = 2_000) -> DataFrame:
    """``docs`` with the repeated windows cut out of ``text``. Bytes of a
    character that was cut through are dropped; a null text becomes empty."""
    out = remove_repeats(docs, length, run, decoded=True)
    return out.select(*[F.col("kept").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
