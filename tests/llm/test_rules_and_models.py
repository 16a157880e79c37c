"""Quality rules, quality classifier and toxicity."""

import math
import random
import zlib

import numpy as np
import pytest
from helpers import WORDS, clashing, docs, empty, odd_rows

from tablewise.llm import common, quality_mil, quality_rules, toxicity

SF = "/root/testdata/sf0.1"


def brute_counts(text):
    raw = (text or "").encode()
    words = WORDS.findall(raw)
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(chr(b) in "#*$%&|<>" for b in raw)
    lines = [x for x in raw.split(b"\n") if WORDS.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)}
    return len(words), chars, symbols, dup, len(covered)


def count_rows():
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("a b c dé\n e# |".split(" ")) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    return rows + [r for r in odd_rows() if r[0] != 3 and r[0] is not None] + [(None, None)]


def test_counts(spark):
    rows = count_rows()
    got = quality_rules.with_counts(clashing(docs(spark, rows)).drop("stratum")).collect()
    want = sorted([(-1 if i is None else i, *brute_counts(t)) for i, t in rows])
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"],
                   r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want


def test_binomial_tail_is_exact():
    for n, p in ((1, 0.3), (12, 0.05), (40, 0.5)):
        for x in range(n + 1):
            want = sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(x + 1))
            assert math.isclose(math.exp(quality_rules.log_binomial_tail(x, n, p)), want, rel_tol=1e-9)


def test_certificates_hold_their_promise():
    """With a true false-rejection rate just above alpha, a certificate is
    rarer than its level."""
    alpha, level, n = 0.05, 0.02, 300
    limit = max((x for x in range(n) if quality_rules.certified(x, n, alpha, level)), default=-1)
    assert limit >= 0 and math.exp(quality_rules.log_binomial_tail(limit, n, alpha)) <= level
    assert not quality_rules.certified(limit + 1, n, alpha, level)
    assert not quality_rules.certified(0, 0, alpha, level)


def test_choice_stops_at_the_first_failure():
    rows = [("en", "r", 0.5, 2000, 0, 10), ("en", "r", 0.4, 2000, 500, 900), ("en", "r", 0.3, 2000, 0, 950),
            ("de", "r", 0.5, 20, 0, 20), (None, "r", 0.5, 2000, 1, 30), (None, "r", 0.4, 2000, 1, 30)]
    got = quality_rules.choose(rows, 0.05, 0.05).cutoffs
    assert got == {("en", "r"): 0.5, (None, "r"): 0.5}  # too few labels in "de"; ties go to the lenient cutoff


def labelled(spark):
    good = [(i, " ".join(f"word{i}x{j}" for j in range(60))) for i in range(700)]
    bad = [(1000 + i, " ".join(f"w{i}x{j}%%%" for j in range(60))) for i in range(100)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 1) for i, _ in bad]
                                   + [(5, 0, 0), (None, 1, 0), (7, None, None), (99999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    return good + bad, labels


def test_every_stratum_with_enough_labels_gets_its_cutoffs(spark):
    rows = spark.range(8 * 1100).selectExpr(
        "id AS doc_id", "nullif(concat('s', id % 1100), 's7') AS stratum", "id >= 5 * 1100 AS bad")
    features = rows.selectExpr("doc_id", "stratum", "100L AS n_words", "500L AS word_chars",
                               "if(bad, 200L, 0L) AS n_symbols", "0L AS n_dup_lines", "0L AS n_repeat_words")
    labels = rows.selectExpr("doc_id", "cast(NOT bad AS int) AS quality")
    # At an alpha of 0.9 a rule, five good documents are enough.
    out = quality_rules.verdict(features, quality_rules.fit(features, labels, 3.6, 0.05))
    assert out.where("kept").count() == 5 * 1100 == out.where("kept AND n_symbols = 0").count()
    assert out.count() == 8 * 1100 and out.columns == [*features.columns, "base_failed", "kept"]


def test_rules_reject_what_labels_show(spark):
    rows, labels = labelled(spark)
    rows += [(5000, "%% " * 100), (5001, " ".join(f"clean{j}" for j in range(80))), (None, None)]
    d = docs(spark, rows)
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(d, labels).collect()}
    assert all(kept[i] for i in range(700)) and not any(kept[1000 + i] for i in range(100))
    assert not kept[5000] and kept[5001] and not kept[None]
    out = quality_rules.passing(clashing(d).drop("stratum"), labels)
    assert out.columns == clashing(d).drop("stratum").columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, k in kept.items() if k)
    none = quality_rules.quality_rules(d, labels.limit(0))
    assert none.where("kept = base_failed").count() == 0
    assert quality_rules.quality_rules(empty(spark), labels).count() == 0
    assert quality_rules.passing(empty(spark), labels).count() == 0


def hits(spark, name, score):
    d, lab = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = score(d, lab)
    assert out.count() == d.count()
    held = out.join(lab, "doc_id").where("held_out").select("score", "predicted", name).toPandas()
    assert held["score"].between(0, 1).all()
    return held


def test_quality_on_held_out_labels(spark):
    held = hits(spark, "quality", quality_mil.quality_mil)
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert good.predicted.mean() >= 0.98 and (1 - bad.predicted).mean() >= 0.85


def test_toxicity_on_held_out_labels(spark):
    held = hits(spark, "toxic", toxicity.toxicity)
    toxic, other = held[held.toxic == 1], held[held.toxic == 0]
    assert toxic.predicted.mean() >= 0.7 and other.predicted.mean() <= 0.01


@pytest.mark.parametrize("score", [quality_mil.quality_mil, toxicity.toxicity])
def test_models_on_odd_tables(spark, score):
    rows, labels = labelled(spark)
    d = clashing(docs(spark, rows[::8] + odd_rows()))
    out = score(d, labels).collect()
    assert len(out) == len(rows[::8] + odd_rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in out)
    for r in out:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert score(empty(spark), labels).count() == 0
    alone = score(docs(spark, odd_rows()), labels.limit(0)).collect()
    assert len(alone) == len(odd_rows())


def test_sample_is_full_where_few_labelled_ids_have_a_text_that_fits(spark):
    labels = spark.range(4000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    rows = [(i, "long " * 50 if i < 1000 else f"text {i}") for i in range(1040)]
    sample, share = common.labelled_sample(docs(spark, rows), labels, "quality", 10, 20)
    assert sorted(y for _, y in sample) == [0] * 10 + [1] * 10 and abs(share - 0.5) < 0.1
    assert all(len(t) <= 20 for t, _ in sample)


def test_sample_never_holds_the_held_out_fold(spark):
    rows, labels = labelled(spark)
    marked = [(i, f"id{i} " + t) for i, t in rows]
    sample, share = common.labelled_sample(docs(spark, marked), labels, "quality", 50, 1 << 14)
    ids = [int(t.split()[0][2:]) for t, _ in sample]
    assert len(ids) == 100 and all(zlib.crc32(str(i).encode()) % 5 for i in ids)
    assert 0 < share < 1


def test_bags_do_not_depend_on_slabs(monkeypatch):
    rng = np.random.default_rng(0)
    rows = [(bytes(rng.integers(97, 123, 3000).tolist()), i % 2) for i in range(12)]
    model = quality_mil.train(rows, 0.5, epochs=2)
    texts = [t for t, _ in rows] + [b"", b"x" * 9000]
    want = quality_mil.score_texts(model, texts)
    monkeypatch.setattr(quality_mil, "SLAB_PASSAGES", 3)
    assert np.allclose(quality_mil.score_texts(model, texts), want, atol=1e-5)


def all_maximal(scores):
    """Maximal scoring segments by their definition: recursively the
    leftmost shortest segment of largest positive score."""
    def best(a, b):
        top = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                key = (round(total, 9), -(j - i), -i)
                if total > 1e-12 and (top is None or key > top[0]):
                    top = (key, i, j)
        if top is None:
            return []
        _, i, j = top
        return best(a, i) + [(i, j, round(sum(scores[i:j + 1]), 6))] + best(j + 1, b)
    return best(0, len(scores))


def test_segments_are_all_maximal_ones():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(0, 14)
        gap = -0.75
        scores = [rng.choice([gap, gap, 1.25, 2.0]) for _ in range(n)]
        got = [(a, b, round(s, 6)) for a, b, s in
               toxicity.segments([(i, x) for i, x in enumerate(scores) if x > 0], gap)]
        assert got == all_maximal(scores)


def test_copies_of_one_text_certify_nothing(spark):
    good = " ".join(f"word{j}" for j in range(60))
    rows = [(i, good) for i in range(600)] + [(1000 + i, " ".join(f"w{i}x{j}%%%" for j in range(60))) for i in range(20)]
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    features = quality_rules.with_counts(docs(spark, rows))
    assert quality_rules.fit(features, labels).count() == 0
    assert quality_rules.quality_rules(docs(spark, rows), labels).where("NOT kept").count() == 0


def test_repeated_rows_keep_the_error_rate(spark):
    """Strata whose false-rejection rate is just above what is promised, every
    text given 1 to 40 times: certificates are as rare as without copies."""
    rng = random.Random(6)
    alpha, rules, trials, rate = 0.4, 4, 150, 0.105
    rows, texts = [], 0
    for s in range(trials):
        for _ in range(60):
            texts += 1
            bad = rng.random() < rate
            rows += [(len(rows) + k, f"s{s}", texts, 100, 500, 400 if bad else 0, 0, 0) for k in range(rng.choice([1, 1, 40]))]
    features = spark.createDataFrame(rows, "doc_id long, stratum string, text_key long, n_words long, word_chars long, "
                                           "n_symbols long, n_dup_lines long, n_repeat_words long")
    labels = features.selectExpr("doc_id", "1 AS quality")
    cutoffs = quality_rules.fit(features, labels, alpha, delta=0.2 * trials * rules)  # each sequence at level 0.2
    assert cutoffs.where("symbols_per_char IS NOT NULL").count() <= 0.3 * trials


def test_a_toxicity_score_by_its_definition(spark):
    rows, _ = labelled(spark)
    sample = [(t.encode(), int(i >= 1000)) for i, t in rows]
    sample += [(f"{' '.join(f'plain{k}' for k in range(9))} zap zork {k}".encode(), 1) for k in range(80)]
    model = toxicity.fit_model(sample)
    text = "plain1 zap zork zap plain2 " + "plain3 " * 300 + "zork zap zap, " + "plain4 " * 50 + "zork"
    words = [w.strip(toxicity.TRIM) for w in text.encode().lower().split()]
    weight = [model.weights.get(w, model.prefixes.get(w[:toxicity.PREFIX], model.gap) if len(w) >= toxicity.LONGER
                                else model.gap) for w in words]
    found = [s for *_, s in all_maximal_fast(weight)]
    normal = [model.lam * s - math.log(model.k * len(words)) for s in found]
    x = sum(v for v in normal if math.exp(-v) <= model.max_expected) or toxicity.NO_SEGMENT
    want = 1 / (1 + math.exp(-(model.slope * math.log1p(x + 1) + model.shift)))
    got = toxicity.score(docs(spark, [(1, text)]), model).first()
    assert math.isclose(got["score"], want, rel_tol=1e-9) and x > 0
    assert len(got["spans"]) == sum(math.exp(-v) <= model.max_expected for v in normal)


def all_maximal_fast(scores):
    """`all_maximal` with sums of the runs between positive scores."""
    hits = [i for i, s in enumerate(scores) if s > 0]
    total = [0.0]
    for s in scores:
        total.append(total[-1] + s)

    def best(part):
        top = max(((total[j + 1] - total[i], -(j - i), -i, i, j) for a, i in enumerate(part) for j in part[a:]), default=None)
        if top is None:
            return []
        i, j = top[3:]
        return best([h for h in part if h < i]) + [(i, j, top[0])] + best([h for h in part if h > j])
    return best(hits)


def test_segment_scan_is_linear():
    import time

    def cost(n):
        hits = [(3 * i, 1.0 + (i % 7) / 10) for i in range(n)]
        times = []
        for _ in range(3):
            t = time.process_time()
            toxicity.segments(hits, -0.6)
            toxicity.segments([(100 * i, 1.0) for i in range(n)], -0.3)
            times.append(time.process_time() - t)
        return min(times)
    assert cost(64_000) <= 8 * cost(16_000)


def test_a_quality_score_by_plain_loops():
    rng = np.random.default_rng(1)
    h, a = 5, 3
    m = quality_mil.MilModel(rng.normal(size=(quality_mil.INPUTS, h)), rng.normal(size=h), rng.normal(size=(h, a)),
                             rng.normal(size=(h, a)), rng.normal(size=a), rng.normal(size=h), 0.3)
    text = ("some words, some more words and so on " * 60).encode()
    parts = [text[k:k + quality_mil.PASSAGE] for k in range(0, len(text), quality_mil.PASSAGE)]

    def dot(u, v):
        return sum(float(x) * float(y) for x, y in zip(u, v))

    def sig(x):
        return 1 / (1 + math.exp(-x))
    embedded, attention = [], []
    for part in parts:
        x = quality_mil.encode_passages(np.frombuffer(part, np.uint8), np.array([0]))[0]
        e = [math.tanh(dot(x, m.embed[:, j]) + m.embed_b[j]) for j in range(h)]
        embedded.append(e)
        attention.append(sum(float(m.attend[k]) * math.tanh(dot(e, m.tanh[:, k])) * sig(dot(e, m.gate[:, k])) for k in range(a)))
    weight = [math.exp(v) / sum(map(math.exp, attention)) for v in attention]
    bag = [sum(w * e[j] for w, e in zip(weight, embedded)) for j in range(h)]
    assert math.isclose(quality_mil.score_texts(m, [text])[0], sig(dot(bag, m.out) + m.out_b), rel_tol=1e-4)
