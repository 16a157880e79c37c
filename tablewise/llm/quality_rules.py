"""Quality rules with risk-controlled thresholds.

Every document gets a few counts. Two fixed base rules reject documents that
are too short or mostly repeat themselves. On top of them, ratio rules reject
documents above a cutoff, and each cutoff is chosen on labelled documents so
that, with confidence 1 - delta over all strata, rules and candidate cutoffs
together, it rejects at most a share alpha / (number of rules) of the good
documents of its stratum: exact one-sided binomial bounds, tested from the
lenient to the strict cutoff until one fails (fixed sequence), with a
Bonferroni correction over strata and rules. A stratum with too few labelled documents gets no cutoff: its
documents are only held to the base rules.

The bounds ask for independent trials, so a text counts once in a stratum,
however many rows and ids repeat it: the guarantee is over distinct texts.
(Texts that differ are trials of their own, near-copies too.)

Defined cases: empty and null texts have no words and fail the base rules; a
text of any length is counted whole; repeated rows are judged one by one, all
alike; a null stratum value is a stratum of its own; labels whose document is
missing are not used; an id or text that is labelled twice counts as good if
one label says so; of cutoffs that reject equally well the more lenient is
taken; without labels only the base rules hold; an empty table gives no rows;
other columns may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.broadcast import bounded_broadcast
from .common import SPACES, binary_labels, map_batches, settle

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

SYMBOLS = b"#*$%&|<>"


def count_text(text: bytes) -> tuple[int, int, int, int, int]:
    """The counts of one UTF-8 text, in the order of COUNTS."""
    words = text.split()
    n = len(words)
    chars = len(text.decode("utf-8", "replace")) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeat = 0
    if n >= 3:
        grams = list(zip(words, words[1:], words[2:]))
        if len(set(grams)) < len(grams):
            seen, twice = set(), set()
            for g in grams:
                (twice if g in seen else seen).add(g)
            end = 0
            for i, g in enumerate(grams):
                if g in twice:
                    repeat += i + 3 - max(i, end)
                    end = i + 3
    return n, chars, symbols, dup_lines, repeat


def with_counts(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``(doc_id, stratum, text_key)`` and the counts of every row;
    ``text_key`` is the text's SHA-256."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(stratum).cast("string").alias("stratum"),
                         F.unhex(F.sha2(text, 256)).alias("text_key"), text.alias("text"))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [count_text(t) for t in batch.column("text").to_pylist()]
        cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "stratum", "text_key")), *cols],
                                          ["doc_id", "stratum", "text_key", "n_words", "word_chars", "n_symbols",
                                           "n_dup_lines", "n_repeat_words"])
    return map_batches(source, count, f"doc_id long, stratum string, text_key binary, {COUNTS}")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def ratios() -> dict[str, Column]:
    """Rule name -> value; a rule rejects a document whose value is above its cutoff."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "symbols_per_char": F.col("n_symbols") / chars,
        "chars_per_word": F.col("word_chars") / words / 40,
        "dup_lines_per_word": F.col("n_dup_lines") / words,
        "repeat_words_share": F.col("n_repeat_words") / words,
    }


#: Candidate cutoffs of every rule, from lenient to strict.
CUTOFFS = tuple(round(x, 4) for x in (0.5, 0.4, 0.35, 0.3, 0.25, 0.225, 0.2, 0.175, 0.15, 0.125, 0.1, 0.08,
                                      0.06, 0.05, 0.04, 0.03, 0.02, 0.015, 0.01, 0.005))


def log_binomial_tail(x: int, n: int, p: float) -> float:
    """log P(X <= x) for X ~ Binomial(n, p), summed exactly term by term."""
    if p <= 0:
        return 0.0
    if p >= 1:
        return 0.0 if x >= n else -math.inf
    lp, lq = math.log(p), math.log1p(-p)
    terms = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * lp + (n - k) * lq
             for k in range(min(x, n) + 1)]
    top = max(terms)
    return min(0.0, top + math.log(sum(math.exp(t - top) for t in terms)))


def certified(rejected: int, good: int, alpha: float, level: float) -> bool:
    """Whether the exact upper confidence bound (at 1 - level) of the false
    rejection rate is at most alpha: had the rate been alpha, so few
    rejections would come with probability at most ``level``."""
    if good == 0 or rejected >= alpha * good:
        return False
    return log_binomial_tail(rejected, good, alpha) <= math.log(level)


@dataclass(frozen=True)
class Thresholds:
    """Certified cutoffs: (stratum, rule) -> cutoff."""
    cutoffs: dict[tuple[str | None, str], float]


def choose(counts: list[tuple[str | None, str, float, int, int, int]],
           alpha: float, delta: float, sequences: int | None = None) -> Thresholds:
    """Of the certified cutoffs of each stratum and rule, the one that
    rejects the most bad documents less the good ones; ties go to the more
    lenient. ``counts``: (stratum, rule, cutoff, good documents, good
    rejected, bad rejected), the cutoffs of a stratum and rule from lenient
    to strict; ``sequences`` if there are more of them than ``counts`` has."""
    tests: dict[tuple[str | None, str], list[tuple[float, int, int, int]]] = {}
    for stratum, rule, *rest in counts:
        tests.setdefault((stratum, rule), []).append(tuple(rest))
    rules = len({r for _, r in tests}) or 1
    found: dict[tuple[str | None, str], float] = {}
    for key, sequence in tests.items():
        best = 0
        for cutoff, good, good_rejected, bad_rejected in sequence:
            # Fixed sequence: the first cutoff that fails ends the testing,
            # so the cutoffs of one sequence share one error level.
            if not certified(good_rejected, good, alpha / rules, delta / (sequences or len(tests))):
                break
            if bad_rejected - good_rejected > best:
                best = bad_rejected - good_rejected
                found[key] = cutoff
    return Thresholds(found)


def fit(features: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """``(stratum, cutoff per rule)`` of the strata with a certified cutoff,
    from the labelled rows of ``features``, each text (or id, without
    ``text_key``) once. Only documents that pass the base
    rules count. Every stratum with labels has its share of the error level;
    those with too few good labels to certify anything are not looked at."""
    rules = ratios()
    trial = "text_key" if "text_key" in features.columns else "doc_id"
    joined = (features.where(~base_failed())
              .join(binary_labels(labels, "quality"), "doc_id")
              .groupBy("stratum", trial)
              .agg(F.max("label").alias("label"), *[F.max(v).alias(r) for r, v in rules.items()]))
    good = F.col("label") == 1
    aggs = [F.count_if(good).alias("good")]
    for r in rules:
        for i, c in enumerate(CUTOFFS):
            aggs += [F.count_if(good & (F.col(r) > c)).alias(f"{r}_{i}_g"),
                     F.count_if(~good & (F.col(r) > c)).alias(f"{r}_{i}_b")]
    counts = settle(joined.groupBy("stratum").agg(*aggs))
    names, sequences = list(rules), max(1, counts.count() * len(rules))
    # Without a single false rejection the tail is (1 - alpha / rules) ** good.
    least = math.log(delta / sequences) / math.log1p(-alpha / len(names))

    def pick(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.to_pylist()
        found = choose([(s["stratum"], r, c, s["good"], s[f"{r}_{i}_g"], s[f"{r}_{i}_b"])
                        for s in rows for r in names for i, c in enumerate(CUTOFFS)], alpha, delta, sequences).cutoffs
        return pa.RecordBatch.from_arrays(
            [batch.column("stratum"), *[pa.array([found.get((s["stratum"], r)) for s in rows], pa.float64())
                                        for r in names]], ["stratum", *names])
    able = counts.where(F.col("good") >= math.floor(least))
    return settle(map_batches(able, pick, "stratum string, " + ", ".join(f"{r} double" for r in names))
                  .where(F.coalesce(*names).isNotNull()))


def verdict(features: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``features`` plus ``base_failed`` and ``kept``."""
    rules = ratios()
    limits = bounded_broadcast(cutoffs.select(F.col("stratum").alias("_stratum"), F.struct(*rules).alias("_cutoffs")))
    rejected = F.lit(False)
    for rule, value in rules.items():
        rejected = rejected | F.coalesce(value > F.col(f"_cutoffs.{rule}"), F.lit(False))
    return (features.join(limits, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~rejected).drop("_stratum", "_cutoffs"))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang",
                  alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """One row per document: doc_id, stratum, the counts, base_failed, kept."""
    features = settle(with_counts(docs, stratum))
    return verdict(features, fit(features, labels, alpha, delta))


def passing(docs: DataFrame, labels: DataFrame, stratum: str = "lang",
            alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they
    are. The counts are made twice, once to fit and once beside the text, so
    no text is shuffled."""
    thresholds = fit(with_counts(docs, stratum), labels, alpha, delta)
    schema = docs.schema
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(stratum).cast("string").alias("stratum"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [count_text(t) for t in batch.column("text").to_pylist()]
        cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
        return pa.RecordBatch.from_arrays([batch.column("row"), batch.column("stratum"), *cols],
                                          ["row", "stratum", "n_words", "word_chars", "n_symbols",
                                           "n_dup_lines", "n_repeat_words"])
    counted = map_batches(wide, count, f"row {schema.simpleString()}, stratum string, {COUNTS}")
    return verdict(counted, thresholds).where("kept").select("row.*")
