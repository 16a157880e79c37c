"""Frequent items and item sets without a shuffle of all items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.broadcast import bounded_broadcast, broadcast_per_group
from ..plans.keys import join_on_keys
from ..plans.lineage import materialize


def unseen_bound(n, tracked: int):
    """How often at most an item of ``n`` occurs that the summary of
    ``tracked`` counters does not report. Its counter table has the next power
    of two that is 4/3 of ``tracked``; a count is wrong by at most 3.5 n over
    that size, and an item is reported if its lower bound passes the error."""
    size = 1 << (-(-4 * tracked // 3) - 1).bit_length()
    return n * 7.0 / size


def heavy_hitters(df: DataFrame, group: str, item: str, k: int, tracked: int = 8192) -> DataFrame:
    """The ``k`` most frequent items of every group, exactly: group, item,
    ``n``, ``rank`` (by falling n, then item).

    1. Every task keeps a summary of ``tracked`` counters per group, merged
       over the tasks: bounded memory, and what is shuffled is one summary per
       task and group. It reports all items above an error bound.
    2. The reported items are counted exactly in a second pass; only their
       counts are shuffled.
    3. A group is done if its k-th count is above what any other item can
       reach (`unseen_bound`), or if its reported items are all of its rows.
       The items of other groups, with no k items that stand out, are counted
       in full.

    Defined cases: null items are not counted; a null group is a group like
    any other; a group of fewer than k items returns them all; ties go by
    item; empty inputs give no rows.
    """
    rows = df.where(F.col(item).isNotNull()).select(F.col(group).alias("_g"), F.col(item).alias("_i"))
    summary = materialize(rows.groupBy("_g").agg(
        F.count(F.lit(1)).alias("_rows"), F.expr(f"approx_top_k_accumulate(_i, {int(tracked)})").alias("_s")))
    reported = materialize(summary.select("_g", F.explode(F.expr(f"approx_top_k_estimate(_s, {int(tracked)})")).alias("_e"))
                           .select("_g", F.col("_e.item").alias("_i")))
    side = bounded_broadcast(reported.select(F.col("_g").alias("_rg"), F.col("_i").alias("_ri")))
    counts = (rows.join(side, F.col("_g").eqNullSafe(F.col("_rg")) & (F.col("_i") == F.col("_ri")))
              .groupBy("_g", "_i").agg(F.count(F.lit(1)).alias("n")))
    best = Window.partitionBy("_g").orderBy(F.desc("n"), "_i")

    def top(c: DataFrame) -> DataFrame:
        return c.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    counts = materialize(counts)
    state = (counts.groupBy("_g").agg(F.sum("n").alias("_seen"))
             .join(top(counts).where(F.col("rank") == k).select(F.col("_g").alias("_kg"), F.col("n").alias("_kth")),
                   F.col("_g").eqNullSafe(F.col("_kg")), "left").drop("_kg"))
    done = join_on_keys(summary.select("_g", "_rows"), state, ["_g"], "left").select(
        "_g", F.coalesce((F.col("_kth") > unseen_bound(F.col("_rows"), tracked)) | (F.col("_seen") == F.col("_rows")),
                         F.lit(False)).alias("_done"))
    done = materialize(done)
    found = top(join_on_keys(counts, broadcast_per_group(done.where("_done").select("_g")), ["_g"]))
    if not done.where("NOT _done").isEmpty():
        rest = join_on_keys(rows, broadcast_per_group(done.where("NOT _done").select("_g")), ["_g"])
        found = found.unionByName(top(rest.groupBy("_g", "_i").agg(F.count(F.lit(1)).alias("n"))))
    return found.select(F.col("_g").alias(group), F.col("_i").alias(item), "n", F.col("rank").cast("int").alias("rank"))


def baskets(df: DataFrame, basket: str, item: str) -> DataFrame:
    """``(basket, items)``: the distinct items of every basket, sorted. Items
    are made distinct before they are gathered, so a basket of very many rows
    holds no more than there are items. Null baskets and items are left out."""
    return (df.where(F.col(basket).isNotNull() & F.col(item).isNotNull()).select(F.col(basket).alias("basket"),
                                                                                  F.col(item).cast("string").alias("item"))
            .distinct().groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("items")))


def frequent_sets(found: DataFrame, share: float, chunk: int = 20_000) -> DataFrame:
    """Pairs and triples of items that at least ``share`` of all `baskets`
    hold: ``items`` (array, sorted), ``baskets``.

    Two passes. A set that reaches the share overall reaches it in at least
    one chunk of the baskets, so the sets that are frequent in some chunk
    (counted inside the task, chunk by chunk, and only sets whose parts are
    frequent) are all that can be frequent. The second pass counts these
    candidates exactly: baskets are cut to items of candidates, and counts are
    added up before they are shuffled.

    Chunks hold ``chunk`` to twice as many baskets (a table of fewer is one
    chunk); below some 5 / ``share`` baskets a chunk names many candidates.
    Defined cases: baskets of one item count for the share; repeated baskets
    count each; an empty input gives no rows.
    """
    found = materialize(found.select("items"))
    total = found.count()
    if not total:
        return found.select("items", F.lit(0).cast("long").alias("baskets")).limit(0)
    need = -int(-share * total // 1) or 1

    def mine(batches):
        import math
        from collections import Counter
        from itertools import combinations

        import pyarrow as pa

        def frequent(some):
            least = math.ceil(share * len(some) - 1e-9)
            one = {x for x, n in Counter(x for b in some for x in b).items() if n >= least}
            kept = [[x for x in b if x in one] for b in some]
            two = {p for p, n in Counter(p for b in kept for p in combinations(b, 2)).items() if n >= least}
            three = Counter(t for b in kept for t in combinations(b, 3)
                            if (t[0], t[1]) in two and (t[0], t[2]) in two and (t[1], t[2]) in two)
            sets = [list(s) for s in two] + [list(t) for t, n in three.items() if n >= least]
            return pa.RecordBatch.from_arrays([pa.array(sets, pa.list_(pa.string()))], ["items"])
        held = []
        for batch in batches:
            held += batch.column("items").to_pylist()
            while len(held) >= 2 * chunk:
                yield frequent(held[:chunk])
                held = held[chunk:]
        if held:
            yield frequent(held)
    # Whole chunks: a partition of few baskets would name almost all sets.
    parts = max(1, total // (2 * chunk))
    candidates = materialize(found.repartition(parts, F.xxhash64("items", F.monotonically_increasing_id()))
                             .mapInArrow(mine, "items array<string>").distinct())
    known = bounded_broadcast(candidates.select(F.explode("items").alias("item")).distinct())
    # Numbered in a step of its own: beside explode every item would get a number.
    rows = (found.withColumn("row", F.monotonically_increasing_id()).select("row", F.explode("items").alias("item"))
            .join(known, "item").groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    pairs = F.flatten(F.transform("items", lambda x, i: F.transform(
        F.slice("items", i + 2, F.size("items")), lambda y: F.array(x, y))))
    triples = F.flatten(F.transform("items", lambda x, i: F.flatten(F.transform(
        F.slice("items", i + 2, F.size("items")), lambda y, j: F.transform(
            F.slice("items", i + j + 3, F.size("items")), lambda z: F.array(x, y, z))))))
    sets = rows.select(F.explode(F.concat(pairs, triples)).alias("items"))
    return (sets.join(bounded_broadcast(candidates), "items").groupBy("items").agg(F.count(F.lit(1)).alias("baskets"))
            .where(F.col("baskets") >= need))
