"""Packing into windows: best fit against a plain version, whole results."""

import random
import zlib
from collections import Counter

import numpy as np
from helpers import clashing, docs, empty, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewise.llm import byte_tokens, tokens, window_packing


def plain_best_fit(lengths, capacity):
    windows = []
    for x in sorted(lengths, reverse=True):
        fits = [(capacity - s, i) for i, s in enumerate(windows) if capacity - s >= x]
        if fits:
            windows[min(fits)[1]] += x
        else:
            windows.append(x)
    return windows


def check_places(lengths, capacity, slack):
    p = window_packing.plan(Counter(lengths), capacity, slack)
    size = np.array(sorted(lengths, reverse=True), np.int64)
    piece, begin, tokens_, window, offset = (x.tolist() for x in window_packing.located(p, np.arange(len(size)), size))
    parts, windows = {}, {}
    for i, b, n, w, o in zip(piece, begin, tokens_, window, offset):
        parts.setdefault(i, []).append((b, n))
        windows.setdefault(w, []).append((o, n))
    for i, x in enumerate(size.tolist()):
        at = 0
        for b, n in sorted(parts[i]):
            assert b == at and n > 0
            at += n
        assert at == x
    for some in windows.values():
        at = 0
        for o, n in sorted(some):
            assert o == at
            at += n
        assert at <= capacity and (capacity - at <= slack or at & (at - 1) == 0)
    return len([1 for some in parts.values() if len(some) > 1])


def test_plan_against_plain_best_fit():
    rng = random.Random(5)
    for _ in range(400):
        capacity = rng.choice([8, 12, 16, 64])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        _, opened, n = window_packing.best_fit(Counter(lengths), capacity)
        want = plain_best_fit(lengths, capacity)
        assert n == len(want)
        assert sorted(capacity - room for room, _, k in opened for _ in range(k)) == sorted(s for s in want if s < capacity)
        for slack in (0, 2):
            check_places(lengths, capacity, slack)


def test_few_documents_are_cut():
    lengths = [600] * 500 + [300] * 50 + list(range(1, 200))
    cut = check_places(lengths, 1024, 0)
    missing = sum(1024 - s for s in plain_best_fit(lengths, 1024) if s < 1024 and s & (s - 1))
    assert cut <= 2 * (missing // 1024 + 1) + 2


def test_segment_tree_finds_the_tightest():
    rng = random.Random(7)
    opened, rooms = window_packing.OpenWindows(100), []
    for k in range(2000):
        size = rng.randint(1, 100)
        want = min((r for r in rooms if r >= size), default=None)
        assert opened.tightest(size) == want
        if want and rng.random() < 0.5:
            opened.take(want)
            rooms.remove(want)
        else:
            opened.add(size, k, 1)
            rooms.append(size)


def test_table_is_packed_whole(spark):
    rows = [*odd_rows(), *[(100 + k, f"copy of a text {k % 3} " * (k % 40)) for k in range(120)]]
    capacity = 128
    out = window_packing.pack_windows(clashing(docs(spark, rows)), capacity=capacity).collect()
    enc = byte_tokens.encoder(byte_tokens.default_vocabulary())
    ids = [enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for _, t in rows]
    by_doc = {}
    for r in out:
        by_doc.setdefault(-1 if r["doc_id"] is None else r["doc_id"], []).append(r)
    for i in {k for k, _ in rows}:
        texts = [x for (k, _), x in zip(rows, ids) if k == i]
        got = by_doc[-1 if i is None else i]
        assert sum(r["length"] for r in got) == sum(map(len, texts))
        for r in got:
            assert r["ids_crc32"] in {zlib.crc32(np.array(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
                                      for x in texts if len(x) == r["doc_tokens"]}
    windows = {}
    for r in out:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for some in windows.values():
        at = 0
        for o, n in sorted(some):
            assert o == at
            at += n
        assert at == capacity or at & (at - 1) == 0
    assert window_packing.pack_windows(empty(spark)).count() == 0


EDGES = ["", " ", "a", "It's O'Neil's don't 'tis. x'.", "<|endoftext|> a<|endoftext", "a   b  c　 d \n\n e",
         "日本語。 テスト", "a1b2 3.14% $5 #tag @x", "\x1c\x1d a\x85b \x85 c", "''s 's. t's's", "\x00a �", "A.B,C;;d%%%e", "x \t y"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text() | st.text(alphabet=st.sampled_from(" \n\t 　ab'.é日1")) | st.sampled_from(EDGES), max_size=5))
def test_byte_encoder_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    e = byte_tokens.encoder(byte_tokens.default_vocabulary())
    got = [np.frombuffer(b, "<u4").tolist() for b in e.encode([t.encode() for t in texts])]
    assert got == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_byte_encoder_cuts_long_texts(monkeypatch):
    monkeypatch.setattr(tokens, "STORE_PARTS", 5)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 64)
    monkeypatch.setattr(byte_tokens, "CHUNK", 50)
    e = byte_tokens.ByteEncoder(byte_tokens.default_vocabulary())
    texts = [" ".join(f"word{i}  stop.\n" for i in range(n)) for n in (1, 3, 40, 0, 2)]
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode([t.encode() for t in texts])] \
        == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
