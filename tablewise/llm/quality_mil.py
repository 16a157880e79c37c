"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (consecutive slices of ``PASSAGE`` bytes,
the last one shorter). Every passage is encoded by byte statistics: the
shares of single bytes and of hashed byte pairs, of words equal to the word
before and of words seen before in the passage, all square-rooted. A small
network embeds each passage, gated attention (tanh times sigmoid) weighs the
embeddings, and the weighted sum is scored; everything is learnt from the
documents' labels alone.

The network is trained on the driver on a bounded sample of labelled
documents (``per_class`` of each label, by a hash of the id, none longer than
``sample_bytes``); its score is set to the labels' true odds afterwards, so 0
to 1 reads as a probability. Scoring reads every text whole, passage by
passage.

Defined cases: null and empty texts are one empty passage and get a score;
without labels of both kinds every document scores the known share of good
labels (0.5 without any label); repeated rows are scored each; labels, lang,
source and doc_id are no inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, map_batches, texts, train_fold

PASSAGE = 512
PAIRS = 256
INPUTS = 256 + PAIRS + 2
SLAB_PASSAGES = 4096


@dataclass(frozen=True)
class MilModel:
    embed: np.ndarray    # inputs x hidden
    embed_b: np.ndarray
    tanh: np.ndarray     # hidden x attention
    gate: np.ndarray
    attend: np.ndarray   # attention
    out: np.ndarray      # hidden
    out_b: float


def encode_passages(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Byte and byte-pair shares of the passages that begin at ``starts`` in
    the buffer ``text`` (the last one ends with it)."""
    n = len(starts)
    sizes = np.diff(np.append(starts, len(text)))
    owner = np.repeat(np.arange(n), sizes)
    out = np.zeros((n, INPUTS), np.float32)
    if len(text):
        single = np.bincount(owner * 256 + text, minlength=n * 256).reshape(n, 256)
        out[:, :256] = single
        code = (text[:-1].astype(np.int64) * 31 + text[1:] * 17) % PAIRS
        same = owner[:-1] == owner[1:]
        pair = np.bincount(owner[:-1][same] * PAIRS + code[same], minlength=n * PAIRS)
        out[:, 256:256 + PAIRS] = pair.reshape(n, PAIRS)
    out /= np.maximum(sizes, 1)[:, None].astype(np.float32)
    raw = text.tobytes()
    for i, (at, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
        words = raw[at:at + size].split()
        if words:
            out[i, -2] = sum(map(eq, words, words[1:])) / len(words)
            out[i, -1] = 1 - len(set(words)) / len(words)
    return np.sqrt(out)


def passage_starts(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all passages in the joined texts, and each text's number of
    passages (one at least)."""
    counts = np.array([max(1, -(-s // PASSAGE)) for s in sizes])
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(first, counts) + within * PASSAGE, counts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def passage_parts(m: MilModel, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding and unnormalised attention logit of each passage."""
    h = np.tanh(x @ m.embed + m.embed_b)
    return h, (np.tanh(h @ m.tanh) * sigmoid(h @ m.gate)) @ m.attend


class BagSum:
    """Softmax-weighted mean of a document's passages, slab by slab."""

    def __init__(self, hidden: int):
        self.top, self.weight, self.total = -np.inf, 0.0, np.zeros(hidden)

    def add(self, h: np.ndarray, a: np.ndarray) -> None:
        top = max(self.top, float(a.max()))
        old = np.exp(self.top - top) if self.weight else 0.0
        w = np.exp(a - top)
        self.weight = self.weight * old + float(w.sum())
        self.total = self.total * old + w @ h
        self.top = top

    def mean(self) -> np.ndarray:
        return self.total / self.weight


def score_texts(m: MilModel, batch: list[bytes]) -> np.ndarray:
    """Scores of whole texts; long ones are encoded in slabs, so memory is
    bounded by the slab and not by the text."""
    scores = np.empty(len(batch))
    limit = SLAB_PASSAGES * PASSAGE
    group: list[int] = []
    size = 0

    def run() -> None:
        buf = np.frombuffer(b"".join(batch[i] for i in group), np.uint8)
        starts, counts = passage_starts([len(batch[i]) for i in group])
        h, a = passage_parts(m, encode_passages(buf, starts))
        first = np.cumsum(counts) - counts
        w = np.exp(a - np.repeat(np.maximum.reduceat(a, first), counts))
        z = np.add.reduceat(w[:, None] * h, first) / np.add.reduceat(w, first)[:, None]
        scores[group] = sigmoid(z @ m.out + m.out_b)

    for i, text in enumerate(batch):
        if len(text) > limit:
            bag = BagSum(len(m.out))
            for at in range(0, len(text), limit):
                part = np.frombuffer(text, np.uint8, min(limit, len(text) - at), at)
                bag.add(*passage_parts(m, encode_passages(part, passage_starts([len(part)])[0])))
            scores[i] = sigmoid(bag.mean() @ m.out + m.out_b)
            continue
        group.append(i)
        size += max(len(text), 1)
        if size >= limit:
            run()
            group, size = [], 0
    if group:
        run()
    return scores


def train(rows: list[tuple[bytes, int]], good_share: float, hidden: int = 24, attention: int = 12,
          epochs: int = 30, rate: float = 0.01, seed: int = 7) -> MilModel:
    """Fit on (text, label) rows with Adam; classes weigh alike in training
    and the bias is moved to the odds of ``good_share`` afterwards."""
    rng = np.random.default_rng(seed)
    bags = []
    for text, _ in rows:
        buf = np.frombuffer(text, np.uint8)
        bags.append(encode_passages(buf, passage_starts([len(text)])[0]))
    y = np.array([label for _, label in rows], np.float64)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    p = {"embed": rng.normal(0, 1 / np.sqrt(16), (INPUTS, hidden)), "embed_b": np.zeros(hidden),
         "tanh": rng.normal(0, 1 / np.sqrt(hidden), (hidden, attention)),
         "gate": rng.normal(0, 1 / np.sqrt(hidden), (hidden, attention)),
         "attend": rng.normal(0, 1 / np.sqrt(attention), attention),
         "out": rng.normal(0, 1 / np.sqrt(hidden), hidden), "out_b": np.zeros(1)}
    first_moment = {k: np.zeros_like(v) for k, v in p.items()}
    second_moment = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            ids = order[at:at + 64]
            x = np.concatenate([bags[i] for i in ids]).astype(np.float64)
            counts = np.array([len(bags[i]) for i in ids])
            first = np.cumsum(counts) - counts
            bag = np.repeat(np.arange(len(ids)), counts)
            h = np.tanh(x @ p["embed"] + p["embed_b"])
            t, g = np.tanh(h @ p["tanh"]), sigmoid(h @ p["gate"])
            a = (t * g) @ p["attend"]
            w = np.exp(a - np.maximum.reduceat(a, first)[bag])
            w /= np.add.reduceat(w, first)[bag]
            z = np.add.reduceat(w[:, None] * h, first)
            # Backwards.
            d_logit = (sigmoid(z @ p["out"] + p["out_b"]) - y[ids]) * weight[ids] / len(ids)
            grad = {"out": z.T @ d_logit, "out_b": np.array([d_logit.sum()])}
            dz = (d_logit[:, None] * p["out"])[bag]
            d_w = (dz * h).sum(axis=1)
            d_a = w * (d_w - np.add.reduceat(w * d_w, first)[bag])
            grad["attend"] = (t * g).T @ d_a
            d_tg = d_a[:, None] * p["attend"]
            d_t, d_g = d_tg * g * (1 - t * t), d_tg * t * g * (1 - g)
            grad["tanh"], grad["gate"] = h.T @ d_t, h.T @ d_g
            d_h = (w[:, None] * dz + d_t @ p["tanh"].T + d_g @ p["gate"].T) * (1 - h * h)
            grad["embed"], grad["embed_b"] = x.T @ d_h, d_h.sum(axis=0)
            step += 1
            for k in p:
                first_moment[k] += 0.1 * (grad[k] - first_moment[k])
                second_moment[k] += 0.001 * (grad[k] ** 2 - second_moment[k])
                p[k] -= rate * (first_moment[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second_moment[k] / (1 - 0.999 ** step)) + 1e-8)
    odds = np.log(good_share / (1 - good_share))
    f = {k: v.astype(np.float32) for k, v in p.items() if k != "out_b"}
    return MilModel(**f, out_b=float(p["out_b"][0] + odds))


def score(docs: DataFrame, model: MilModel | None, fallback: float = 0.5) -> DataFrame:
    """``(doc_id, score)`` of every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column("text").to_pylist()
        s = np.full(len(raw), fallback) if model is None else score_texts(model, raw)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])
    return map_batches(texts(docs), run, "doc_id long, score double")


def quality_mil(docs: DataFrame, labels: DataFrame, per_class: int = 2000,
                sample_bytes: int = 1 << 14) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    rows, share = labelled_sample(docs, labels, "quality", per_class, sample_bytes)
    both = len({label for _, label in rows}) == 2
    model = train(rows, share) if both else None
    return score(docs, model, share).select(
        "doc_id", (train_fold("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))
