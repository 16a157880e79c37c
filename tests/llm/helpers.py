"""Hand-made documents and brute-force versions shared by the tests."""

from __future__ import annotations

import re
from collections import Counter



DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def docs(spark, rows, schema=DOCS):
    """Documents from (doc_id, text) rows; the other columns are filled."""
    full = [(i, t, "en", f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


def odd_rows():
    """Nulls, empty and white texts, a long text, repeated rows, unusual characters."""
    long = " ".join(f"word{i % 997} other{i % 31}" for i in range(30_000))
    return [(None, None), (None, "a b c d e f"), (1, ""), (2, " \t\n "), (3, long), (4, "same text here " * 20),
            (4, "same text here " * 20), (5, "İstanbul é́ 日本語 😀 <|endoftext|> it's."), (6, "x"),
            (7, "\x00 \x1c\x85 tail"), (8, "a" * 5000), (9, "one two\nthree four\n\nfive\n" * 5)]


def clashing(df):
    """Columns whose names the operators use inside."""
    for c in ("kid", "ksum", "row", "spans", "node", "n", "g", "key", "stratum", "length", "ids", "start", "digit"):
        df = df.withColumn(c, df["doc_id"])
    return df


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def shingles(text, k):
    w = WORDS.findall((text or "").encode().lower())
    return frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_components(rows, k, num, den):
    sets = {i: shingles(t, k) for i, t in rows}
    ids = list(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[:x] if sets[a] and sets[b]
             and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in components(ids, links).items()}


def removed_bytes(texts, length):
    """Per text: whether each byte lies in a window that starts elsewhere too."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        out.append((t, gone))
    return out


def runs_of(flags):
    return sum(1 for i, f in enumerate(flags) if f and (i == 0 or not flags[i - 1]))


def dedup_lines(rows):
    """rows: distinct (doc_id, text), sorted -> removed line numbers per id."""
    first, gone = {}, {i: set() for i, _ in rows}
    for i, t in rows:
        ls = (t or "").split("\n")
        for p in range(len(ls) - 2):
            first.setdefault(tuple(ls[p:p + 3]), (i, p))
    for i, t in rows:
        ls = (t or "").split("\n")
        for p in range(len(ls) - 2):
            f = first[tuple(ls[p:p + 3])]
            if f != (i, p):
                gone[i].update(range(max(p, f[1] + 3) if f[0] == i else p, p + 3))
    return gone


