"""Toxic passages as maximum-scoring segments.

1. Word weights. On labelled training documents each word gets the log-odds
   of occurring in toxic against other documents with an informative
   Dirichlet prior (the word's share of all training documents' words, half
   an occurrence at least). Its weight is the lower end of the interval of
   ``z`` standard deviations, and it counts if that passes ``min_weight``;
   every other word has the same small negative score. Occurrences are
   counted once per document, so one long text cannot make a word toxic. The
   first PREFIX bytes of longer words are weighed in the same way and stand
   in for words that have no weight of their own.
2. Segments. All maximal scoring segments of a text are found in one pass
   (Ruzzo and Tompa). Runs of unlisted words are one negative item, so the
   pass is linear in the listed words.
3. Calibration. The largest segment score of a text of n words without
   toxicity follows an extreme-value law: P(S >= s) ~ 1 - exp(-K n e^(-lambda s)).
   lambda solves sum p(score) e^(lambda score) = 1 over the words of
   non-toxic training documents, K matches their segment scores. A segment
   is significant if its expected number in such a text is at most
   ``max_expected``.
4. Score. Sum over the significant segments of lambda s - ln(K n), put
   through a logistic curve fitted on the training documents.

The model is fitted on a bounded sample of labelled rows (``per_class`` of
each label, by a hash of the id, none longer than ``sample_bytes``), its
score moved to the labels' true odds; every text is scored whole.

Defined cases: a null or empty text scores as a text without segments; a text
of any length is scored whole; without usable labels of both kinds every text
scores 0; of segments that could be cut in several ways the shortest is
found; repeated rows are scored each, alike; a null id is held out or not like
an empty string; an empty table gives no rows; other columns may have any
name.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, map_batches, texts, train_fold

TRIM = b".,;:!?\"'()[]"
PREFIX, LONGER = 4, 6  # bytes of a prefix; of the shortest word that has one
NO_SEGMENT = -1.0  # feature of a text without a significant segment


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[bytes, float]
    prefixes: dict[bytes, float]
    gap: float  # score of an unlisted word
    lam: float
    k: float
    slope: float
    shift: float
    max_expected: float = 0.05


def word_list(text: bytes) -> list[bytes]:
    return [w.strip(TRIM) for w in text.lower().split()]


def word_weights(toxic: Counter, other: Counter, prior: float, z: float, min_weight: float) -> dict[bytes, float]:
    """Lower ends of the words' log-odds with a Dirichlet prior, where they
    pass ``min_weight``. The counters hold documents per word."""
    n_t, n_o = sum(toxic.values()), sum(other.values())
    total, out = n_t + n_o, {}
    for w in toxic:
        a = max(0.5, prior * (toxic[w] + other[w]) / total)
        t, o = toxic[w] + a, other[w] + a
        d = math.log(t / (n_t + prior - t)) - math.log(o / (n_o + prior - o)) - z * math.sqrt(1 / t + 1 / o)
        if d >= min_weight:
            out[w] = d
    return out


def segments(hits: list[tuple[int, float]], gap: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a text
    whose listed words are ``hits`` (position, score > 0) and whose other
    words score ``gap`` < 0 each."""
    # [left total, right total, first word, last word, the last earlier entry
    # with a smaller left total]: entries in between have no smaller one and
    # are never looked at again, which keeps the scan linear.
    found: list[list[float]] = []
    total, last = 0.0, -1
    for pos, score in hits:
        total += gap * (pos - last - 1)
        left, total, last = total, total + score, pos
        cur, j = [left, total, pos, pos, -1], len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= cur[0]:
                j = found[j][4]
            if j < 0 or found[j][1] >= cur[1]:
                cur[4] = j
                found.append(cur)
                break
            before = found[j]
            cur, k = [before[0], cur[1], before[2], cur[3], -1], before[4]
            del found[j:]
            j = k
    return [(int(a), int(b), r - l) for l, r, a, b, _ in found]


def text_segments(model: ToxicityModel, text: bytes) -> tuple[int, list[tuple[int, int, float]]]:
    words, own, prefix = word_list(text), model.weights, model.prefixes
    hits = [(i, own[w] if w in own else prefix[w[:PREFIX]]) for i, w in enumerate(words)
            if w in own or w[:PREFIX] in prefix and len(w) >= LONGER]
    return len(words), segments(hits, model.gap)


def feature(model: ToxicityModel, n_words: int, found: list[tuple[int, int, float]]) -> float:
    """Sum of the normalised scores of the significant segments."""
    floor = math.log(model.k * max(1, n_words))
    normal = [model.lam * s - floor for _, _, s in found]
    kept = [x for x in normal if x >= -math.log(model.max_expected)]
    return sum(kept) if kept else NO_SEGMENT


def decay(weights: list[float], shares: list[float], gap: float, rest: float) -> float:
    """lambda > 0 with sum share e^(lambda weight) + rest e^(lambda gap) = 1."""
    def excess(x: float) -> float:
        return sum(p * math.exp(min(700.0, x * w)) for w, p in zip(weights, shares)) + rest * math.exp(x * gap) - 1
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if excess(mid) > 0 else (mid, high)
    return max(high, 1e-3)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a slightly regularised logistic fit of y on x."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + 1e-2 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        w -= np.linalg.solve(h, g)
    return float(w[0]), float(w[1])


def fit_model(rows: list[tuple[bytes, int]], prior: float = 500.0, z: float = 1.28, min_weight: float = 3.2,
              gap: float = -0.05, max_expected: float = 0.05) -> ToxicityModel | None:
    """The model from (text, label) rows; None without both labels."""
    counts, starts, words = (Counter(), Counter()), (Counter(), Counter()), [0, 0]
    for text, label in rows:
        w = word_list(text)
        once = set(w)
        counts[label].update(once)
        starts[label].update({x[:PREFIX] for x in once if len(x) >= LONGER})
        words[label] += len(w)
    if not counts[0] or not counts[1]:
        return None
    weights = word_weights(counts[1], counts[0], prior, z, min_weight)
    prefixes = word_weights(starts[1], starts[0], prior, z, min_weight)
    every = [*weights.values(), *prefixes.values()]
    shares = [(counts[0][w] + 0.5) / words[0] for w in weights] + [(starts[0][w] + 0.5) / words[0] for w in prefixes]
    lam = decay(every, shares, gap, max(0.0, 1 - sum(shares))) if every else 1.0
    model = ToxicityModel(weights, prefixes, gap, lam, 1.0, 1.0, 0.0, max_expected)
    done = [(*text_segments(model, text), label) for text, label in rows]
    # K: a text of n words without toxicity has K n e^(-lambda s) segments
    # above s; matched at the smallest weight, half a segment added.
    least = min(every, default=1.0)
    above = 0.5 + sum(s >= least for _, f, label in done if not label for _, _, s in f)
    model = replace(model, k=above / words[0] * math.exp(lam * least))
    x = np.array([feature(model, m, f) for m, f, _ in done])
    slope, shift = logistic(np.log1p(x + 1), np.array([label for *_, label in done], float))
    return replace(model, slope=max(slope, 0.0), shift=shift)


def score(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``(doc_id, score, spans)``: spans are the significant segments as
    (first word, words, normalised score)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, spans = [], []
        for text in batch.column("text").to_pylist():
            if model is None:
                scores.append(0.0)
                spans.append([])
                continue
            n, found = text_segments(model, text)
            x = feature(model, n, found)
            scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * math.log1p(x + 1) + model.shift)))))
            floor = math.log(model.k * max(1, n)) - math.log(model.max_expected)
            spans.append([{"first": a, "words": b - a + 1, "normal": model.lam * s - floor - math.log(model.max_expected)}
                          for a, b, s in found if model.lam * s >= floor])
        kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("normal", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, kind)],
            ["doc_id", "score", "spans"])
    return map_batches(texts(docs), run,
                       "doc_id long, score double, spans array<struct<first: int, words: int, normal: double>>")


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 4000,
             sample_bytes: int = 1 << 14) -> DataFrame:
    """``(doc_id, held_out, score, predicted, spans)`` of every document."""
    rows, share = labelled_sample(docs, labels, "toxic", per_class, sample_bytes)
    model = fit_model(rows)
    if model:
        sampled = sum(label for _, label in rows) / len(rows)
        odds = share * (1 - sampled) / ((1 - share) * sampled)
        model = replace(model, shift=model.shift + math.log(odds))
    return score(docs, model).select(
        "doc_id", (train_fold("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
