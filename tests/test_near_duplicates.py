"""Near-duplicates against all pairs, and what travels for them."""

import random

from pyspark.sql import functions as F

from tablewise.operators import text_vectors


def grams(text):
    w = text.lower().split()
    return {tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))} if w else set()


def brute(rows):
    sets = [(i, grams(t)) for i, t in rows]
    out = {}
    for i, x in sets:
        near = [(j, len(x & y) / len(x | y)) for j, y in sets if j < i and x and y and 10 * len(x & y) >= 8 * len(x | y)]
        if near:
            j, s = min(near)
            out[i] = (j, int(s * 1e6 + 0.5) / 1e6)
    return out


def copies(seed, groups, each, length, edits):
    """Groups of texts that differ from a text of theirs in some words."""
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.randint(*length))]
        for _ in range(each):
            mine = list(words)
            for _ in range(rng.randint(0, edits)):
                mine[rng.randrange(len(mine))] = f"x{rng.randrange(6)}"
            out.append(" ".join(mine))
    rng.shuffle(out)
    return list(enumerate(out))


def found(spark, rows):
    got = text_vectors.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    return {r["doc_id"]: (r["dup_of"], r["jaccard"]) for r in got.collect()}


def test_against_all_pairs(spark):
    rows = copies(1, 12, 8, (1, 12), 2) + [(1000 + i, t) for i, t in copies(2, 6, 12, (60, 200), 8)] + [(2000, None), (2001, " ")]
    want = brute([(i, t or "") for i, t in rows])
    assert len(want) > 40 and found(spark, rows) == want


def test_only_sets_of_compared_pairs_travel_and_few_grams_are_counted(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(f"u{i}.{k}" for k in range(150))) for i in range(40)]
    text = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    rows += [(100 + i, " ".join([*text[:75], f"n{i}", *text[76:]])) for i in range(30)]  # each like each
    frames, joined = [], []
    real, join = text_vectors.materialize, text_vectors.skew_join
    monkeypatch.setattr(text_vectors, "materialize", lambda df: frames.append(real(df)) or frames[-1])
    monkeypatch.setattr(text_vectors, "skew_join", lambda x, y, *a: joined.append(x.count()) or join(x, y, *a))
    assert found(spark, rows) == {100 + i: (100, 0.960265) for i in range(1, 30)}
    sent = [f.count() for f in frames if "_set" in f.columns]
    assert sent[0] == 70 and max(sent[1:]) <= 30  # all sets once, in place; then those of a pair
    # A set is first compared with one other, 435 pairs are candidates.
    first = [f for f in frames if "_p" in f.columns][0]
    assert first.count() == 435 and [f.count() for f in frames if "_p" in f.columns][1] == 0
    # Two fifths of the 70 x 148 grams are counted.
    assert len(joined) == 1 and joined[0] < 0.5 * 70 * 148


def test_rows_written_in_place_are_not_shuffled_again(spark):
    df = spark.range(100).repartition(8, "id").groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    with text_vectors.in_place(spark):
        kept = text_vectors.materialize(df)
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
    assert "Exchange" not in kept.groupBy("id").agg(F.sum("n"))._jdf.queryExecution().executedPlan().toString()
