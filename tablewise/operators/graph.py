"""Triangles and clustering of a graph given as an edge table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_div, stable_round
from ..plans.broadcast import DEFAULT_MAX_ROWS, broadcast_per_group
from ..plans.keys import skew_join
from ..plans.lineage import in_place, materialize


def _busiest(ends: DataFrame, max_rows: int) -> DataFrame:
    """``(node, d)``: how often the busiest nodes are in the rows of ``ends``,
    at most ``max_rows`` of them, all that reach some power of two."""
    counts = ends.groupBy("node").agg(F.count(F.lit(1)).alias("d"))
    sizes = counts.groupBy(F.floor(F.log2("d")).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    least, left = 64, max_rows
    for p, n in sorted(sizes.collect(), reverse=True):  # one row per power of two
        left -= n
        if left < 0:
            break
        least = p
    return counts.where(F.col("d") >= F.lit(1 << least if least < 63 else (1 << 63) - 1))


def triangles(edges: DataFrame, a: str, b: str, digits: int = 6, kind: Callable[[Column], Column] | None = None,
              max_hubs: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``(node, degree, triangles, clustering)`` of every node of the
    undirected graph of the rows (a, b): how many other nodes it is linked
    with, how many triangles it is in, and which share of the pairs of its
    neighbours are linked (null below a degree of 2).

    Every edge points from the less busy node to the busier one. Rows are
    counted per node, and the ``max_hubs`` busiest nodes are broadcast and
    come last, by count; the others come by ``kind`` and node. So a hub's
    neighbours are never paired with each other, and no node points at more
    than the larger of sqrt(2 x rows) and 4 x rows / max_hubs others. Where nodes
    fall into kinds without links inside a kind (not checked if ``kind`` is
    given: such links are an error of the caller), kinds with short lists
    should have the lower numbers.

    All wedges of an edge (u, v) are one row: what u points at after v, of
    other kinds, met with what v points at. The row holds 16 bits of a hash
    of each node; what v points at and has the same bits goes back to u, where the
    lists lie in place, and is compared with its whole list. A hub that many edges point
    at is a hot key of the first join; adaptive execution splits it. Of a
    triangle one row per node is added up in the task before the shuffle.

    ``edges`` is read three times (twice for the counts). Defined cases: repeated and reversed edges are one
    edge; loops and edges with a null end are left out, and so are nodes that
    have no others; an empty table gives no rows.
    """
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    e = edges.where(x != y).select(x.alias("x"), y.alias("y"))
    hubs = broadcast_per_group(_busiest(e.select(F.explode(F.array("x", "y")).alias("node")), max_hubs))
    of = lambda end: hubs.select(F.col("node").alias(end), F.col("d").alias(f"d{end}"))
    e = e.join(of("x"), "x", "left").join(of("y"), "y", "left")
    rank = lambda n: kind(n).cast("long") if kind else F.lit(0).cast("long")
    d = {c: F.coalesce(f"d{c}", F.lit(0)).cast("long") for c in "xy"}
    place = {c: F.struct(d[c], rank(F.col(c)), F.col(c)) for c in "xy"}
    up = place["x"] < place["y"]
    ends = [F.struct(d[c].alias("d"), F.col(c).alias("node")) for c in "xy"]
    points = e.select(F.when(up, F.col("x")).otherwise(F.col("y")).alias("u"),
                      F.when(up, ends[1]).otherwise(ends[0]).alias("end"))
    found = F.array_sort(F.transform(F.collect_set("end"), lambda t: F.struct(
        t["d"].alias("d"), rank(t["node"]).alias("rank"), t["node"].alias("node"))))
    with in_place(edges.sparkSession):
        out = materialize(points.groupBy("u").agg(found.getField("node").alias("out")))
    # A node's kind and 16 bits of its hash as one number.
    code = lambda n: rank(n) * (1 << 16) + F.pmod(F.xxhash64(n), F.lit(1 << 16))
    bits = lambda c: (c % (1 << 16) - (1 << 15)).cast("short")
    coded = out.select("u", "out", F.transform("out", code).alias("codes"))
    later = F.expr("slice(codes, p + 2, size(codes))")
    if kind:
        later = F.filter(later, lambda c: F.shiftright(c, 16) != F.col("k"))
    wedges = (coded.select("u", "codes", F.posexplode(F.arrays_zip("out", "codes")).alias("p", "t"))
              .select("u", "codes", "p", "t.out", F.shiftright("t.codes", 16).alias("k"))
              .select("u", F.col("out").alias("v"), F.explode_outer(F.filter(F.array(later), lambda x: F.size(x) > 0)).alias("l"))
              .where(F.col("l").isNotNull()).select("u", "v", F.transform("l", bits).alias("later")))
    lists = coded.select(F.col("u").alias("v"), "out", F.transform("codes", bits).alias("bits"))
    # One array in another, so that what it holds is computed once a row.
    some = F.transform(F.array(F.array_intersect("later", "bits")), lambda both: F.filter(
        "out", lambda w, i: F.array_contains(both, F.get("bits", i))))
    maybe = (skew_join(wedges, lists, ["v"])
             .select("u", "v", F.explode_outer(F.filter(some, lambda x: F.size(x) > 0)).alias("some"))
             .where(F.col("some").isNotNull()))
    closed = (maybe.join(out, "u").select("u", "v", F.array_intersect("some", "out").alias("w"))
              .where(F.size("w") > 0))
    share = lambda node, n: F.struct(F.col(node).alias("node"), n.cast("long").alias("n"))
    each = F.concat(F.array(share("u", F.size("w")), share("v", F.size("w"))),
                    F.transform("w", lambda w: F.struct(w.alias("node"), F.lit(1).cast("long").alias("n"))))
    found = (closed.select(F.explode(each).alias("t")).groupBy(F.col("t.node").alias("node"))
             .agg(F.sum("t.n").alias("triangles")))
    degree = (out.select(F.explode("out").alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
              .unionByName(out.select(F.col("u").alias("node"), F.size("out").cast("long").alias("n")))
              .groupBy("node").agg(F.sum("n").alias("degree")))
    n, d = F.coalesce("triangles", F.lit(0)).cast("long"), F.col("degree").cast("double")
    return degree.join(found, "node", "left").select(
        "node", "degree", n.alias("triangles"),
        stable_round(safe_div(2.0 * n, d * (d - 1)), digits).alias("clustering"))
