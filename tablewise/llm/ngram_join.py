"""N-gram Jaccard join by T-occurrence search.

A document is the set of its distinct k-word shingles, and two documents link
if their Jaccard similarity reaches ``share``. For a document of n shingles a
partner occurs in at least T = ceil(share * n) of its n inverted lists. As in
DivideSkip, the lists are divided: of the lists in a fixed order only the
first n - T + t are merged, where any partner occurs at least t times, and
the rest are probed, by binary search in the sorted set of the few candidates
that reach t. The order puts lists of at most ``short`` documents first (by
hash), so the merge reads short lists. Two documents whose sizes are close
must meet more often than t times (`Share.times_col`).

1. Every distinct set is a node. A sketch keeps its smallest hashes, more
   than the merge needs. Lists over the sketches are counted; those longer
   than ``short`` are long.
2. Nodes with enough short lists merge them: pairs that meet in a short list
   (at most ``short`` partners each) are counted, and pairs that meet t
   times are candidates.
3. The other nodes consist mostly of long lists (large groups of
   near-copies). Their whole sets are read. Against all nodes they merge
   their remaining short lists. Among themselves, with the lists that are
   rarest among them first, they link in rounds of stars: each list names a
   center, each node is verified against the centers it meets most often, and
   verified links join components. What is left between components is searched
   in cells (`_between`): nodes are dealt into blocks, two blocks that share a
   list meet in a task, and inside it every node merges its shortest lists of
   the cell and probes the long ones. No pair leaves the task, only an edge per
   component joined. So a group costs links in proportion to its members, and
   rows in proportion to its members times its blocks.
4. Candidates are verified on whole sets; components come from the links.

Defined cases: null and empty texts, and texts of white space, have no
shingles and link with nothing; equal sets are one node and always linked;
rows that share an id are one document with several sets (`jaccard_rows`:
each text for itself); a null id is no id: its row links by its text alone and
names a component only, as null, if no row of it has an id; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.broadcast import bounded_broadcast
from ..plans.ranking import running_total
from .common import NULL_ID, map_batches, map_stream, settle, texts
from .components import components
from .hashing import shingle_set

#: Times a candidate must occur in the merged lists.
TIMES = 3
SHORT = 16
STAR_ROUNDS, STAR_CENTERS = 2, 16
#: Shingles of a block of nodes, a node counted as NODE more; candidates probed at once.
BLOCK, NODE, PROBES = 1 << 17, 256, 64


class Share:
    """Jaccard threshold num / den and what follows from it."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def least(self, n):
        """T: the smallest overlap of a set of n with any partner."""
        return -(-self.num * n // self.den)

    def merged(self, n, times: int = TIMES):
        """Lists to merge for a set of n (an int or an array)."""
        t = self.least(n)
        return n - t + np.minimum(times, t)

    def sketch(self, n: int) -> int:
        return min(n, int(self.merged(n) * 5 // 4) + 4)

    def merged_col(self, n: Column) -> Column:
        t = F.ceil(self.num * n / self.den)
        return n - t + F.least(F.lit(TIMES), t)

    def times_col(self, n: Column, m: Column) -> Column:
        """Times two sets of n and m must meet in merged lists. Of the lists
        they share, those before the end of the shorter of their two merged
        parts (in the common order) are merged for both, and at most the
        unmerged lists of that set come after: the overlap the similarity
        asks for, less the larger number of unmerged lists."""
        overlap = F.ceil(self.num * (n + m) / (self.num + self.den))
        return overlap - F.greatest(n - self.merged_col(n), m - self.merged_col(m))

    def sizes_fit(self, n: Column, m: Column) -> Column:
        return F.least(n, m) * self.den >= F.greatest(n, m) * self.num

    def linked(self, both: int, n: int, m: int) -> bool:
        return self.den * both >= self.num * (n + m - both)


def _sketches(docs: DataFrame, k: int, share: Share, seed: int) -> DataFrame:
    """``(doc_id, ksum, n, key, low)``: hash of every text, size and MD5 of
    its set and the set's smallest hashes."""
    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, key, low = [], [], []
        for text in batch.column("text").to_pylist():
            s = shingle_set(text, k, seed).view(np.int64)
            n.append(len(s))
            key.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
            low.append(s[:share.sketch(len(s))])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("ksum"), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
             pa.array(low, pa.list_(pa.int64()))], ["doc_id", "ksum", "n", "key", "low"])
    source = texts(docs).select("doc_id", F.xxhash64("text").alias("ksum"), "text")
    return map_batches(source, sketch, "doc_id long, ksum long, n long, key binary, low array<long>")


def _whole_sets(docs: DataFrame, nodes: DataFrame, ids: DataFrame, k: int, seed: int) -> DataFrame:
    """``(node, n, hashes)``: the whole sets of the nodes in ``ids``, each
    read once from the text that ``nodes`` names as its first, however many
    rows repeat it."""
    wanted = (nodes.join(ids.select("node").distinct(), "node")
              .select("node", F.col("first.kid").alias("kid"), F.col("first.ksum").alias("ksum")))
    source = (texts(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("kid"), F.xxhash64("text").alias("ksum"),
                                 "text")
              .join(bounded_broadcast(settle(wanted)), ["kid", "ksum"]).select("node", "text").dropDuplicates(["node"]))

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, k, seed) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], ["node", "n", "hashes"])
    return map_batches(source, whole, "node long, n long, hashes binary").where("n > 0")


def _verified(pairs: DataFrame, sets: DataFrame, share: Share) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    def probe(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)  # binary probes of the larger set
            both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            keep.append(share.linked(both, len(x), len(y)))
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]) \
            .filter(pa.array(keep, pa.bool_()))
    sets = sets.select("node", "hashes")
    both = (pairs.join(sets.withColumnsRenamed({"node": "a", "hashes": "x"}), "a")
            .join(sets.withColumnsRenamed({"node": "b", "hashes": "y"}), "b"))
    return map_batches(both.select("a", "b", "x", "y"), probe, "a long, b long").distinct()


def _meeting(left: DataFrame, right: DataFrame, share: Share) -> DataFrame:
    """Pairs of different nodes that meet often enough in the lists of
    ``left`` and ``right`` (node, n, g), each pair counted once per list."""
    y = right.select(F.col("node").alias("b"), F.col("n").alias("m"), "g")
    met = (left.select(F.col("node").alias("a"), "n", "g").join(y, "g")
           .where((F.col("a") != F.col("b")) & share.sizes_fit(F.col("n"), F.col("m"))))
    return (met.groupBy("a", "b", "n", "m").agg(F.count(F.lit(1)).alias("times"))
            .where(F.col("times") >= share.times_col(F.col("n"), F.col("m")))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _among_crowded(sets: DataFrame, share: Share) -> DataFrame:
    """Links among the nodes of ``sets`` (node, n, hashes) that give their
    components: stars first, then what is left between components."""
    def unpack(batch: pa.RecordBatch) -> pa.RecordBatch:
        g = [np.frombuffer(b, "<u8").astype(np.int64) for b in batch.column("hashes").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), pa.array(g, pa.list_(pa.int64()))],
                                          ["node", "n", "gs"])
    # The order among these nodes: rarest among them first.
    rows = map_batches(sets, unpack, "node long, n long, gs array<long>").select("node", "n", F.explode("gs").alias("g"))
    df_ = settle(rows.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    own = Window.partitionBy("node", "n")
    lone = F.col("n") - F.count(F.lit(1)).over(own)  # lists of one node come before all others
    lists = settle(rows.join(df_, "g")
                        .withColumn("r", F.row_number().over(own.orderBy("df", "g")) + lone)
                        .where(F.col("r") <= share.merged_col(F.col("n"))).select("node", "n", "g", "r"))
    links = None
    label = lists.select("node", F.col("node").alias("component")).distinct()
    for r in range(STAR_ROUNDS):
        placed = settle(_placed(lists, label))
        center = F.struct(F.xxhash64("node", F.lit(r)).alias("h"), "node", "n", "component")
        centers = settle(placed.groupBy("g").agg(F.min(center).alias("c"), F.min("component").alias("lo"),
                                                      F.max("component").alias("hi"))
                              .where("lo != hi").select("g", "c"))
        met = (placed.join(centers, "g").where(F.col("component") != F.col("c.component"))
               .where(share.sizes_fit(F.col("n"), F.col("c.n")))
               .groupBy("node", F.col("c.node").alias("other")).agg(F.count(F.lit(1)).alias("times")))
        # The centers a node meets most often; any verified link is a right one.
        nth = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("times"), "other"))
        stars = (met.withColumn("nth", nth).where(F.col("nth") <= STAR_CENTERS)
                 .select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct())
        found = settle(_verified(stars, sets, share))
        links = found if links is None else links.union(found)
        label = settle(components(links).withColumnRenamed("id", "node"))
    placed = settle(_placed(lists, label))
    several = settle(placed.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                          .where("lo != hi").select("g"))
    # Two linked nodes share one of each other's first n - T + 1 lists.
    first = F.col("r") <= F.col("n") - F.ceil(share.num * F.col("n") / share.den) + 1
    left = settle(placed.where(first).join(several, "g").select("node", "n", "component", "g"))
    return links.union(_between(left, sets, share))


def _between(lists: DataFrame, sets: DataFrame, share: Share) -> DataFrame:
    """Links (a, b) that join the components of the nodes in ``lists`` (node,
    n, component, g): any two nodes of different components that share a list
    are compared, and of the links found a task keeps what joins components."""
    # Nodes with a list in common stand together in this order.
    nodes = lists.groupBy("node", "n", "component").agg(F.min("g").alias("near"))
    order = F.struct("near", "n", "node").alias("place")
    weighed = running_total(nodes.select("node", "component", order, (F.col("n") + NODE).alias("weight")),
                            "place", "weight", "before")
    blocks = settle(weighed.select("node", "component", F.floor(F.col("before") / BLOCK).alias("block")))
    members = settle(lists.select("node", "g").join(blocks.select("node", "block"), "node"))
    other = members.select("g", F.col("block").alias("other")).distinct()
    cells = (members.join(other, "g").select("node", "block", "other").distinct()
             .select("node", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                     (F.col("block") > F.col("other")).cast("int").alias("side")))
    cells = (cells.join(blocks.select("node", "component"), "node").join(sets.select("node", "hashes"), "node")
             .repartition("x", "y").sortWithinPartitions("x", "y", "side", "node"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            for x, y, *row in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "side", "node", "component", "hashes"))):
                if (x, y) != cell:
                    yield from joined(cell, rows)
                    cell, rows = (x, y), []
                rows.append(row)
        yield from joined(cell, rows)

    def joined(cell: tuple[int, int] | None, rows: list[list]) -> Iterator[pa.RecordBatch]:
        sets_ = [np.frombuffer(r[3], "<u8") for r in rows]
        found = joining_links(sets_, np.array([r[2] for r in rows], np.int64), np.array([r[0] for r in rows], np.int64),
                              not cell or cell[0] == cell[1], share)
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array([rows[i][1] for i in a], pa.int64()),
                                              pa.array([rows[i][1] for i in b], pa.int64())], ["a", "b"])
    return settle(map_stream(cells, compare, "a long, b long"))


def joining_links(sets: list[np.ndarray], component: np.ndarray, side: np.ndarray, one_block: bool,
                  share: Share) -> list[tuple[int, int]]:
    """Links between sorted sets of different components, as few as join what
    is linked: of sets on side 0 with sets on side 1, or in ``one_block`` of
    all with all. T-occurrence search with DivideSkip: of a set's lists over
    the other side the T - 1 longest are probed, the others merged."""
    left = np.arange(len(sets)) if one_block else np.flatnonzero(side == 0)
    right = left if one_block else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return []
    size = np.array([len(s) for s in sets])
    every = np.concatenate([sets[j] for j in right])
    order = np.argsort(every, kind="stable")
    member = np.repeat(right, size[right])[order]  # the lists, one after the other, each in order
    grams, first, length = np.unique(every[order], return_index=True, return_counts=True)
    label, links = component.copy(), []
    for i in left.tolist():
        least = share.least(len(sets[i]))
        at = np.searchsorted(grams, sets[i])
        lists = at[grams[np.minimum(at, len(grams) - 1)] == sets[i]]
        if len(lists) < least:
            continue
        lists = lists[np.argsort(length[lists], kind="stable")]
        short, long = lists[:len(lists) - least + 1], lists[len(lists) - least + 1:]
        # Merge: the runs are in order already, so sorting them merges them.
        n = length[short]
        runs = np.repeat(first[short] - np.cumsum(n) + n, n) + np.arange(n.sum())
        partner, times = np.unique(np.sort(member[runs], kind="stable"), return_counts=True)
        fits = (np.minimum(size[partner], size[i]) * share.den >= np.maximum(size[partner], size[i]) * share.num)
        while True:
            keep = fits & (label[partner] != label[i])
            partner, times, fits = partner[keep], times[keep], fits[keep]
            if not len(partner):
                break
            some, both = partner[:PROBES], times[:PROBES].copy()
            if len(some) < len(long):
                wanted = grams[long]
                for k, j in enumerate(some.tolist()):
                    p = np.searchsorted(sets[j], wanted)
                    both[k] += (sets[j][np.minimum(p, size[j] - 1)] == wanted).sum()
            else:
                for g in long.tolist():
                    run = member[first[g]:first[g] + length[g]]
                    p = np.searchsorted(run, some)
                    both += run[np.minimum(p, len(run) - 1)] == some
            for j in some[share.den * both >= share.num * (size[i] + size[some] - both)].tolist():
                if label[j] != label[i]:
                    links.append((i, j))
                    label[label == label[j]] = label[i]
            partner, times, fits = partner[PROBES:], times[PROBES:], fits[PROBES:]
    return links


def _placed(lists: DataFrame, label: DataFrame) -> DataFrame:
    """``lists`` with each node's component so far."""
    return lists.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _same_id(known: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """Links (a, b) between the sets of one id, if an id has several rows."""
    several = settle(known.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
                     .where("rows > 1").select("doc_id"))
    if not several.limit(1).count():
        return None
    member = settle(known.select("doc_id", "key").join(several, "doc_id").distinct()
                    .join(nodes.select("key", "node"), "key").select("doc_id", F.col("node").alias("a")))
    return member.join(member.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").where("a != b").select("a", "b")


def jaccard_rows(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10, short: int = SHORT,
                 by_id: bool = False) -> DataFrame:
    """``(doc_id, ksum, n_shingles, first)`` per row: ``ksum`` is xxhash64 of
    the text; ``first`` (none, kid, ksum) is the id and text hash of the first
    row of its component, rows without an id (``none``) last. Texts link at a
    Jaccard similarity of ``num / den`` or more and, with ``by_id``, if they
    share an id."""
    share = Share(num, den)
    seed = secrets.randbits(63)  # of this call; every task gets the same
    sketches = settle(_sketches(docs, k, share, seed))
    known = sketches.where("n > 0")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(NULL_ID)).alias("kid"), "ksum")
    nodes = settle(known.groupBy("key").agg(F.min(first).alias("first"), F.first("n").alias("n"),
                                            F.first("low").alias("low"))
                   .withColumn("node", F.monotonically_increasing_id()))
    posts = nodes.select("node", "n", F.size("low").alias("kept"), F.posexplode("low").alias("rank", "g"))
    shared = settle(nodes.select(F.explode("low").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("df"))
                         .where("df > 1").select("g", (F.col("df") > short).cast("int").alias("long")))
    per_node = Window.partitionBy("node", "n")
    before = per_node.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    hits = (posts.join(shared, "g")
            .withColumn("long_before", F.coalesce(F.sum("long").over(before), F.lit(0)))
            .withColumn("crowded", F.col("kept") - F.sum("long").over(per_node) < share.merged_col(F.col("n"))))
    hits = settle(hits.where(F.col("crowded") | (
        (F.col("long") == 0) & (F.col("rank") - F.col("long_before") < share.merged_col(F.col("n")))))
        .select("node", "n", "g", "crowded"))
    merge = hits.where("not crowded").select("node", "n", "g")
    met = merge.select(F.col("node").alias("b"), F.col("n").alias("m"), "g")
    pairs = settle(
        merge.join(met, "g").where((F.col("node") > F.col("b")) & share.sizes_fit(F.col("n"), F.col("m")))
        .groupBy(F.col("node").alias("a"), "b", "n", "m").agg(F.count(F.lit(1)).alias("times"))
        .where(F.col("times") >= share.times_col(F.col("n"), F.col("m"))).select("a", "b"))
    crowded = settle(hits.where("crowded").select("node").distinct())
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    if not crowded.limit(1).count():
        links = _verified(pairs, settle(_whole_sets(docs, nodes, wanted, k, seed)), share)
    else:
        sets = settle(_whole_sets(docs, nodes, crowded, k, seed))
        links = _among_crowded(sets, share)

        # The crowded nodes' first short lists, over their whole sets.
        def unpack(batch: pa.RecordBatch) -> pa.RecordBatch:
            g = [np.frombuffer(b, "<u8").astype(np.int64) for b in batch.column("hashes").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"),
                                               pa.array(g, pa.list_(pa.int64()))], ["node", "n", "gs"])
        every = map_batches(sets, unpack, "node long, n long, gs array<long>") \
            .select("node", "n", F.posexplode("gs").alias("rank", "g"))
        rare = every.join(settle(shared.where("long = 1").select("g")), "g", "left_anti")
        nth = F.row_number().over(Window.partitionBy("node", "n").orderBy("rank"))
        rare = settle(rare.withColumn("nth", nth).where(F.col("nth") <= share.merged_col(F.col("n")))
                           .select("node", "n", "g"))
        near = _meeting(rare, posts.select("node", "n", "g").join(
            rare.select("g").distinct(), "g", "left_semi"), share)
        pairs = settle(pairs.union(near).distinct())
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node"))
        links = links.union(_verified(pairs, settle(_whole_sets(docs, nodes, wanted, k, seed)), share))
    same = _same_id(known, nodes) if by_id else None
    label = settle(components(links if same is None else links.union(same)).withColumnRenamed("id", "node"))
    low = settle(label.join(nodes.select("node", "first"), "node")
                 .groupBy("component").agg(F.min("first").alias("low")))
    low = label.join(bounded_broadcast(low), "component").select("node", "low")
    placed = settle(nodes.select("key", "node", "first").join(low, "node", "left")
                    .select("key", F.coalesce("low", "first").alias("first")))
    out = sketches.select("doc_id", "ksum", "n", "key").join(placed, "key", "left")
    return out.select("doc_id", "ksum", F.col("n").alias("n_shingles"), F.coalesce("first", first).alias("first"))


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10,
                       short: int = SHORT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row: documents link at a
    Jaccard similarity of ``num / den`` or more; the component is named by
    its smallest doc_id."""
    rows = jaccard_rows(docs, k, num, den, short, by_id=True)
    return rows.select("doc_id", "n_shingles", F.when(~F.col("first.none"), F.col("first.kid")).alias("component_id"))
