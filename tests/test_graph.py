"""Triangles against plain sets."""

import math
import random
from itertools import combinations

from tablewise.operators import graph


def plain(edges):
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for v, ns in near.items():
        t = sum(y in near[x] for x, y in combinations(ns, 2))
        pairs = len(ns) * (len(ns) - 1)
        out[v] = (len(ns), t, math.floor(2.0 * t / pairs * 1e6 + 0.5) / 1e6 if pairs else None)
    return out


def found(spark, edges, schema="a long, b long"):
    df = spark.createDataFrame(edges, schema)
    return {r["node"]: (r["degree"], r["triangles"], r["clustering"])
            for r in graph.triangles(df, *df.columns[:2]).collect()}


def test_triangles_of_random_graphs(spark):
    rng = random.Random(5)
    for n, m in ((8, 40), (60, 300), (400, 900)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        assert found(spark, edges) == plain(edges)


def test_odd_edges_strings_and_clashing_names(spark):
    edges = [("a", "b"), ("b", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("c", "c"), ("d", "d"), (None, "a"), ("a", None),
             ("e", "f")]
    assert found(spark, edges, "u string, v string") == plain(edges)
    wide = spark.createDataFrame([(*e, "x") for e in edges], "`later.x` string, out string, node string")
    assert {r["node"]: r["degree"] for r in graph.triangles(wide, "later.x", "out").collect()} == {
        v: d for v, (d, _, _) in plain(edges).items()}
    assert found(spark, []) == {}
    assert found(spark, [(1, 1), (None, None)]) == {}


def test_a_hub_is_not_squared(spark):
    # A hub of 4,000 nodes and a ring around it: its 8 million pairs of
    # neighbours are never looked at, every other node points at three at most.
    ring = [(i, (i + 1) % 4000) for i in range(4000)]
    edges = ring + [(9999, i) for i in range(4000)]
    sizes = []
    real = graph.materialize

    def seen(df):
        out = real(df)
        if "out" in out.columns:
            sizes.extend(r["n"] for r in out.selectExpr("size(out) AS n").collect())
        return out
    graph.materialize = seen
    try:
        got = found(spark, edges)
    finally:
        graph.materialize = real
    assert got[9999] == (4000, 4000, math.floor(2.0 * 4000 / (4000 * 3999) * 1e6 + 0.5) / 1e6)
    assert set(v for k, v in got.items() if k != 9999) == {(3, 2, math.floor(2 / 3 * 1e6 + 0.5) / 1e6)}
    assert max(sizes) <= 3 and sum(sizes) == 8000


def test_only_hubs_are_ranked_and_kinds_leave_out_wedges(spark, monkeypatch):
    # Users 0, 3, .., items 1, 4, .., shops 2, 5, ..: every row links one of each.
    rng = random.Random(8)
    rows = [(3 * rng.randrange(30), 3 * rng.randrange(60) + 1, 3 * rng.randrange(4) + 2) for _ in range(400)]
    edges = [e for u, i, s in rows for e in ((u, i), (u, s), (i, s))]
    df = spark.createDataFrame(edges, "a long, b long")
    kind = lambda n: graph.F.element_at(graph.F.array(*map(graph.F.lit, (1, 0, 2))), (n % 3 + 1).cast("int"))
    sent, hubs = [], []
    join, busy = graph.skew_join, graph.broadcast_per_group
    monkeypatch.setattr(graph, "skew_join", lambda x, y, *a: sent.append(x) or join(x, y, *a))
    monkeypatch.setattr(graph, "broadcast_per_group", lambda x: hubs.append(x.count()) or busy(x))
    for most in (100_000, 10, 0):
        got = graph.triangles(df, "a", "b", kind=kind, max_hubs=most)
        assert {r["node"]: (r["degree"], r["triangles"], r["clustering"]) for r in got.collect()} == plain(edges)
        assert hubs[-1] <= most
    # Of a wedge 16 bits travel, and only items send: to their users, their shops.
    assert dict(sent[-1].dtypes)["later"] == "array<smallint>"
    near = {}
    for u, i, s in rows:
        near.setdefault(i, (set(), set()))[0].add(u)
        near[i][1].add(s)
    assert sum(len(r["later"]) for r in sent[-1].collect()) == sum(len(us) * len(ss) for us, ss in near.values())


def test_equal_bits_of_other_nodes_make_no_triangle(spark):
    # 600 neighbours on each side are more than the bits tell apart without errors.
    rng = random.Random(9)
    edges = [(a, 10_000 + rng.randrange(50_000)) for a in range(3) for _ in range(1500)] + [(0, 1), (1, 2)]
    assert found(spark, edges) == plain(edges)
