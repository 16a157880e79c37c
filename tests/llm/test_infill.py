"""Fill-in-middle: wavelet matrix, cuts and forms against plain loops."""

import hashlib
import re

import numpy as np
import pytest
from helpers import clashing, docs, empty, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewise.llm import infill
from tablewise.llm.wavelet import WaveletMatrix


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=300))
def test_ranks_and_selects(symbols):
    s = np.array(symbols, np.uint8)
    m, at = WaveletMatrix(s, 3), np.arange(len(s) + 1)
    for c in range(8):
        assert (m.rank(c, at) == np.concatenate(([0], np.cumsum(s == c)))).all()
    some = [1, 4, 6]
    places = np.flatnonzero(np.isin(s, some))
    nth = np.arange(1, len(places) + 2)
    got = m.select(some, nth, np.zeros(len(nth), np.int64), np.full(len(nth), len(s)))
    assert got.tolist() == [*places.tolist(), len(s)]


def draws(doc_id):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[8 * k:8 * k + 8], 16) for k in range(4)]


def expected(doc_id, text, plain=10, spm=20):
    text = text or ""
    h1, h2, h3, h4 = draws(doc_id)
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in infill.MARKERS) or h3 % 100 >= 100 - plain:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = [*odd_rows(), (20, "a<P>b"), (21, "x <M> y"), (22, "<S"), (23, "1a2b"), (24, "é" * 40 + "Ab"), (25, "😀😀 a"),
       (26, "<"), (27, "P> <"), (28, "A" * 300)]


def test_table_against_plain_loops(spark):
    d = clashing(docs(spark, ODD))
    out = infill.restored(infill.fill_in_middle(d)).collect()
    got = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], bytes(r["output"]).decode()) for r in out]
    assert sorted(got, key=str) == sorted((expected(i, t) for i, t in ODD), key=str)
    assert sorted(bytes(r["text"]).decode() for r in out) == sorted(t or "" for _, t in ODD)
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    none = infill.restored(infill.fill_in_middle(empty(spark)))
    assert none.count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 6), st.text(alphabet=st.sampled_from("aZ09 é\n<>PSM日😀.")))))
def test_any_text(rows):
    h = np.array([draws(i) for i, _ in rows], np.int64).reshape(-1, 4)
    got = infill.transform([t.encode() for _, t in rows], h, 10, 20, ("letter",))
    for (i, t), (n, form, a, b, out) in zip(rows, got):
        assert (i, n, form, a, b, out.decode()) == expected(i, t)
        assert infill.restore(out, form) == t.encode()


def test_other_units_and_bytes_that_are_no_text():
    h = np.array([draws(i) for i in range(50)], np.int64)
    texts = [b"ab 12  3\xff\xc3 c4" for _ in range(50)]
    got = infill.transform(texts, h, 0, 50, ("letter", "digit", "space"))
    assert len({n for n, *_ in got}) == 1
    assert all(infill.restore(out, form) == t for t, (_, form, _, _, out) in zip(texts, got))


@pytest.mark.parametrize("share", [0, 100])
def test_shares(share):
    h = np.array([draws(i) for i in range(200)], np.int64)
    got = {r[1] for r in infill.transform([b"some text"] * 200, h, share, 100, ("letter",))}
    assert got == ({"plain"} if share else {"spm"})
