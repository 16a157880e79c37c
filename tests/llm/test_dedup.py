"""Suffix, line, n-gram and embedding dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
from helpers import (clashing, components, dedup_lines, docs, empty, jaccard_components, odd_rows, removed_bytes,
                     runs_of)

from tablewise.llm import hashing, line_dedup, ngram_join, suffix_dedup, vector_dedup
from tablewise.llm.components import components as spark_components


def random_rows(seed, n=60, size=120, words=12):
    """Texts of few words, copies, near-copies, shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 5 == 0 else f"w{i}" for i in range(words)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(15))
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.2:
            t = rng.choice(texts)
        elif texts and kind < 0.5:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = f"edit{rng.randint(0, 9)}"
            t = " ".join(w)
        else:
            t = " ".join(rng.choice(vocabulary) + str(rng.randint(0, 60)) for _ in range(rng.randint(1, size)))
            if kind < 0.7:
                t = f"{t} {passage} tail{rng.randint(0, 99)}"
        texts.append(t)
    return list(enumerate(texts))


def check_removed(spark, rows, length, run=2_000):
    out = suffix_dedup.remove_repeats(clashing(docs(spark, rows)), length, run)
    got = sorted((r["row"]["doc_id"] if r["row"]["doc_id"] is not None else -1, r["n_bytes"],
                  sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]),
                  hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in out.collect())
    want = sorted((i if i is not None else -1, len(t), sum(g), runs_of(g),
                   hashlib.sha256(bytes(b for b, x in zip(t, g) if not x)).hexdigest())
                  for (i, _), (t, g) in zip(rows, removed_bytes([t for _, t in rows], length)))
    assert got == want
    return got


@pytest.mark.parametrize("seed,length,run", [(1, 20, 2_000), (2, 60, 2_000), (3, 20, 2), (4, 60, 1), (5, 60, 3)])
def test_repeated_windows_are_cut(spark, seed, length, run):
    got = check_removed(spark, random_rows(seed), length, run)
    assert any(0 < r[2] < r[1] for r in got)


def test_repeats_inside_a_text_and_odd_rows(spark):
    period = "abcdefghij" * 60
    rows = odd_rows() + [(20, period), (21, "x" * 199), (22, "y" * 200), (23, "z" * 201), (24, "xyz" + "q" * 250)]
    check_removed(spark, rows, 200)


@pytest.mark.parametrize("run", [1, 4, 2_000])
def test_crowded_digits_are_sorted_in_runs(spark, run):
    """A passage of many different texts, whose windows only meet when the
    runs are merged, and a phrase shorter than a window."""
    rng = random.Random(run)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    passage, phrase = word(90), word(45)
    rows = [(i, word(rng.randint(1, 40)) + passage + word(rng.randint(1, 40))) for i in range(25)]
    rows += [(100 + i, word(50) + phrase + word(50)) for i in range(25)]
    rows += [(200, word(9) + passage[:61]), (201, passage[29:] + word(9)), (202, passage[:59])]
    got = check_removed(spark, rows, 60, run)
    assert all(90 <= r[2] < 98 for r in got[:25]) and not any(r[2] for r in got[25:50])  # neighbours may agree by chance
    assert [r[2] > 60 for r in got[50:]] == [True, True, False]


def test_windows_across_chunks(spark, monkeypatch):
    rng = random.Random(5)
    shared = "".join(rng.choice("abcd") for _ in range(150))
    text = "".join(rng.choice("efgh") for _ in range(200)) + shared + "".join(rng.choice("ijkl") for _ in range(90))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)  # for the segments made here; tasks use the real size
    parts = suffix_dedup.segments(text.encode(), 20)
    assert parts[3].sum() == len(text) - 19
    check_removed(spark, [(1, text), (2, shared[10:140])], 20)


def test_texts_of_one_id_with_equal_short_hashes_stay_apart(spark):
    """Two texts without an id and with the same 32-bit hash; a third row
    repeats one of them."""
    from pyspark.sql import functions as F
    pair = (spark.range(300_000).select(F.sha2(F.col("id").cast("string"), 256).alias("t"))
            .groupBy(F.hash(F.col("t").cast("binary"))).agg(F.sort_array(F.collect_list("t")).alias("ts"))
            .where("size(ts) > 1").orderBy("ts").first()["ts"])
    got = check_removed(spark, [(None, pair[0]), (None, pair[1]), (1, pair[0])], 20)
    assert [r[2] for r in got] == [0, 64, 64]


def test_cut_text_keeps_whole_characters_and_columns(spark):
    shared = "é" * 120
    d = docs(spark, [(1, "a" + shared + "b"), (2, "c" + shared + "d"), (3, None)])
    out = suffix_dedup.without_repeats(d)
    assert out.columns == d.columns and out.dtypes == d.dtypes
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "ab", 2: "cd", 3: ""}


def test_empty_tables(spark):
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
    assert ngram_join.jaccard_components(empty(spark)).count() == 0
    assert vector_dedup.near_duplicate_vectors(empty(spark, "vec_id long, embedding array<float>")).count() == 0


def line_rows(seed):
    rng = random.Random(seed)
    return [(i, "\n".join(rng.choice(["a", "b", "c", "", "long line", f"own {i}"]) for _ in range(rng.randint(0, 12))))
            for i in range(40)] + [(100, "a\na\na\na\na\na\na"), (101, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_line_windows(spark, seed):
    rows = line_rows(seed)
    gone = dedup_lines(rows)
    d = clashing(docs(spark, rows))
    out = line_dedup.dedup_lines(d)
    assert out.columns == [*d.columns, "_gone"]
    for r in out.collect():
        text = dict(rows)[r["doc_id"]]
        assert sorted(r["_gone"] or []) == sorted(gone[r["doc_id"]])
        if text is None:
            assert r["text"] is None
        else:
            assert r["text"] == "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[r["doc_id"]])


def test_line_windows_of_odd_and_equal_rows(spark):
    rows = odd_rows() + [(30, "p\nq\nr\ns"), (30, "p\nq\nr\ns"), (None, "p\nq\nr")]
    out = line_dedup.dedup_lines(docs(spark, rows))
    assert out.count() == len(rows)
    # The row without an id sorts first and keeps its lines; equal rows lose theirs alike.
    assert sorted(r["text"] for r in out.where("doc_id = 30").collect()) == ["s", "s"]


@pytest.mark.parametrize("seed,k,num,den,short", [(1, 3, 90, 100, 16), (2, 5, 8, 10, 16), (3, 2, 7, 10, 2),
                                                  (4, 3, 8, 10, 1)])
def test_jaccard_components(spark, seed, k, num, den, short):
    rows = random_rows(seed, n=90, size=60)
    want = jaccard_components(rows, k, num, den)
    out = ngram_join.jaccard_components(clashing(docs(spark, rows)), k, num, den, short)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == want
    assert any(c != i for i, (_, c) in want.items())


def test_large_group_of_near_copies_goes_through_stars(spark):
    rng = random.Random(9)
    base = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(60)] = f"e{rng.randint(0, 300)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"u{i}x{j}" for j in range(30))) for i in range(20)]
    want = jaccard_components(rows, 3, 8, 10)
    out = ngram_join.jaccard_components(docs(spark, rows), 3, 8, 10, short=4)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == want


def test_jaccard_of_odd_rows(spark):
    out = ngram_join.jaccard_components(docs(spark, odd_rows()))
    got = [(r["doc_id"], r["component_id"]) for r in out.collect()]
    assert len(got) == len(odd_rows())
    assert all(a == b for a, b in got)  # rows that share an id are one document


def test_repeated_rows_of_a_crowded_document_keep_their_links(spark):
    """Words by hash: with a row repeated, the first lists of x would be read
    several times over and the later ones, which y shares, not at all."""
    w = sorted((f"w{i}" for i in range(42)), key=lambda t: hashing.shingle_set(t.encode(), 1)[0])
    long = w[8:14]  # in more than 2 sets, so x is crowded; y has one of them less and two words of its own
    x, y = [w[0], *w[3:]], [*w[1:8], *long[1:], *w[14:]]
    rows = [(1, " ".join(x))] * 6 + [(2, " ".join(y))] + [(10 + i, " ".join([*long, f"own{i}"])) for i in range(3)]
    assert len(x) == len(y) == 40 and jaccard_components(rows, 1, 90, 100)[2] == (40, 1)
    out = ngram_join.jaccard_components(docs(spark, rows), 1, 90, 100, short=2)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {1: 1, 2: 1, 10: 10, 11: 11, 12: 12}


def test_rows_without_an_id_link_by_their_text_alone(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(None, a), (5, a), (7, a + " end"), (None, b), (9, b + " end"), (11, b), (None, c), (None, c + " end"),
            (20, "alone here now"), (30, "x y z x y"), (30, a + " more")]
    out = ngram_join.jaccard_components(docs(spark, rows))
    got = sorted(((r["doc_id"], r["component_id"]) for r in out.collect()), key=str)
    # The two texts of 30 are one document, and one of them is like a.
    assert got == sorted([(None, 5), (5, 5), (7, 5), (None, 9), (9, 9), (11, 9), (None, None), (None, None), (20, 20),
                          (30, 5), (30, 5)], key=str)


def test_shingles_do_not_depend_on_chunks(monkeypatch):
    text = (" ".join(f"Word{i % 50}" for i in range(400)) + "\t\nend").encode()
    want = hashing.shingle_set(text, 3)
    monkeypatch.setattr(hashing, "CHUNK", 37)
    assert (hashing.shingle_set(text, 3) == want).all()
    assert (hashing.shingle_set(text.lower(), 3) == want).all()


def cosine_links(rows, threshold):
    ok = {}
    for i, (_, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v, np.float64)
            ok[i] = x / np.linalg.norm(x)
    return [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= threshold]


@pytest.mark.parametrize("block", [2000, 5])
def test_vectors_against_all_pairs(spark, block):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(60)]
    center = rng.normal(size=16)
    rows += [(100 + i, (center + rng.normal(scale=0.12, size=16)).tolist()) for i in range(40)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (201, rows[0][1]), (202, (3 * np.array(rows[1][1])).tolist())]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [None] + [1.0] * 15), (304, [float("nan")] * 16),
             (305, [1.0]), (306, [2.0]), (307, [-1.0]), (None, rows[2][1])]
    links = cosine_links(rows, 0.95)
    comp = components(range(len(rows)), links)
    ids = [-1 if i is None else i for i, _ in rows]
    low = {}
    for k, c in comp.items():
        low[c] = min(low.get(c, ids[k]), ids[k])
    degree = [sum(k in pair for pair in links) for k in range(len(rows))]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "vec_id AS raw")
    out = vector_dedup.near_duplicate_vectors(d, block=block)
    got = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"],
                  -1 if r["component_id"] is None else r["component_id"], r["kept"]) for r in out.collect())
    want = sorted((ids[k], degree[k], low[comp[k]], ids[k] == low[comp[k]]) for k in range(len(rows)))
    assert got == want


def test_hadamard_keeps_lengths_and_near_vectors_share_buckets():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 64))
    assert np.allclose(np.linalg.norm(vector_dedup.rotate(x, 1), axis=1), np.linalg.norm(x, axis=1))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=(500, 64))
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = 0.951 * x + np.sqrt(1 - 0.951 ** 2) * y
    a, b = (vector_dedup.bucket_names(v, 12, 2, 3).reshape(500, -1).tolist() for v in (x, near))
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(a, b)]) >= 0.99


@pytest.mark.parametrize("width", [1, 3, 16, 31, 32, 33, 64, 200])
def test_sketches_lose_no_link_and_tell_unrelated_vectors_apart(width):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(300, width))
    x[100:200] = x[:100] + rng.normal(scale=0.3, size=(100, width))
    x[200] = 0
    x[200, 0] = 1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sketch, side = vector_dedup.sketches(x), np.arange(300) % 2
    for threshold in (0.95, 0.5, -1.0):
        near = x @ x.T >= threshold
        np.fill_diagonal(near, False)
        got = vector_dedup.reachable(sketch, side, threshold, True)
        assert got[near.any(axis=1)].all()
        across = near & (side[:, None] != side)
        assert vector_dedup.reachable(sketch, side, threshold, False)[across.any(axis=1)].all()
        if width == 64 and threshold == 0.95:
            assert got[201:].mean() < 0.05


def test_cells_are_whole_across_batches():
    import pyarrow as pa
    keys = sorted((int(b), int(c)) for b, c in np.random.default_rng(1).integers(0, 6, (500, 2)))
    batches = [pa.RecordBatch.from_pydict({"bucket": [k[0] for k in keys[i:i + n]], "cell": [k[1] for k in keys[i:i + n]]})
               for i, n in [(0, 3), (3, 0), (3, 1), (4, 200), (204, 296)]]
    got = [[(r["bucket"], r["cell"] >> 1) for r in whole.slice(a, b - a).to_pylist()]
           for whole, ranges in vector_dedup.cells(iter(batches)) for a, b in ranges]
    assert [k for g in got for k in g] == [(b, c >> 1) for b, c in keys]
    assert all(len(set(g)) == 1 for g in got) and len(got) == len({(b, c >> 1) for b, c in keys})
    assert list(vector_dedup.cells(iter([]))) == []


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (200, 199)]
    got = {r["id"]: r["component"] for r in
           spark_components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {x for p in links for x in p if x is not None}
    want = components(sorted(ids), [p for p in links if None not in p])
    assert got == want
    assert spark_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_group_below_the_threshold_makes_no_row_per_pair(spark, monkeypatch):
    """A template with one own edit per copy: every pair is at 0.885."""
    from tablewise.llm import ngram_join
    counted, verified = [], ngram_join._verified

    def count(pairs, sets, share):
        counted[-1] += pairs.count()
        return verified(pairs, sets, share)
    monkeypatch.setattr(ngram_join, "_verified", count)
    words = [f"t{i}" for i in range(100)]
    for n in (100, 400):
        counted.append(0)
        rows = [(i, " ".join([*words[:1 + i % 97], f"own{i}", *words[2 + i % 97:]])) for i in range(n)]
        out = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs(spark, rows), 3, 90, 100).collect()}
        assert out == {i: c for i, (_, c) in jaccard_components(rows, 3, 90, 100).items()}
    assert counted[1] <= 6 * counted[0] and counted[1] <= 20 * 400


def test_links_that_join_components():
    from tablewise.llm.ngram_join import Share, joining_links
    rng = np.random.default_rng(4)
    for k in range(60):
        base = [rng.choice(400, 60, replace=False) for _ in range(4)]
        sets = []
        for _ in range(40):
            s = set(base[rng.integers(4)].tolist())
            s -= set(rng.choice(sorted(s), rng.integers(0, 8), replace=False).tolist())
            sets.append(np.array(sorted(s | set(rng.choice(400, rng.integers(0, 5)).tolist())), "<u8"))
        component = np.where(rng.random(40) < 0.2, rng.integers(0, 40, 40), np.arange(40))
        side, share = (rng.random(40) < 0.5).astype(int), Share(8, 10)
        for one in (True, False):
            def linked(a, b):
                both = len(np.intersect1d(sets[a], sets[b]))
                return share.linked(both, len(sets[a]), len(sets[b])) and (one or side[a] != side[b])
            same = [(a, b) for a in range(40) for b in range(a) if component[a] == component[b]]
            want = components(range(40), same + [(a, b) for a in range(40) for b in range(a) if linked(a, b)])
            got = joining_links(sets, component, side, one, share)
            assert all(linked(a, b) for a, b in got) and len(got) < 40
            assert components(range(40), same + got) == want


def test_words_with_one_polynomial_hash_differ(spark):
    a, flip = "a", str.maketrans("ab", "ba")
    for _ in range(11):
        a += a.translate(flip)
    rows = [(1, a[:1024]), (2, a[:1024].translate(flip)), (3, "x" * 70), (4, "x" * 71)]
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs(spark, rows), 3, 90, 100).collect()}
    assert out == {1: 1, 2: 2, 3: 3, 4: 4}
