"""64-bit hashes of byte strings inside a text, computed for many at once."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15
CHUNK = 1 << 18
SLICED = 512  # longer spans are compared whole
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_space = re.compile(rb"[ \t-\r]")


@lru_cache(8)
def _powers(inverse: bool, size: int) -> np.ndarray:
    base = pow(BASE, -1, 1 << 64) if inverse else BASE
    a = np.full(size, base, np.uint64)
    a[0] = 1
    return np.multiply.accumulate(a)


def powers(inverse: bool, size: int) -> np.ndarray:
    """Powers of the base (or its inverse) modulo 2**64, at least ``size``."""
    return _powers(inverse, max(1 << 16, 1 << (size - 1).bit_length()))


def prefix_hashes(text: np.ndarray) -> np.ndarray:
    """p with p[j] - p[i] a multiple of the hash of text[i:j]; see ``span_hash``."""
    p = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers(False, len(text) + 1)[:len(text)], out=p[1:])
    return p


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash modulo 2**64 of the spans [start, end), the same
    wherever a string stands. ``p`` are the text's prefix hashes."""
    return mixed((p[end] - p[start]) * powers(True, len(p))[start])


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of the text on, as one number."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    return np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(text) + 1,), (1,))


def equal_spans(a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes of text ``a`` from ``a_start`` on are those
    of ``b`` from ``b_start`` on, eight at a time; long spans by their slices."""
    a_words = _words(a)
    b_words = a_words if b is a else _words(b)
    equal = np.ones(len(size), bool)
    for i in np.flatnonzero(size > SLICED).tolist():
        n = size[i]
        equal[i] = np.array_equal(a[a_start[i]:a_start[i] + n], b[b_start[i]:b_start[i] + n])
    rows, done = np.flatnonzero(size <= SLICED), 0
    while len(rows):
        left = size[rows] - done
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.minimum(left, 8).astype(np.uint64) * np.uint64(8))
        unlike = ((a_words[a_start[rows] + done] ^ b_words[b_start[rows] + done]) & mask) != 0
        equal[rows[unlike]] = False
        rows, done = rows[~unlike & (left > 8)], done + 8
    return equal


def distinct_spans(text: np.ndarray, start: np.ndarray, stop: np.ndarray,
                   hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first, which): ``first`` are the numbers of the spans [start, stop)
    that differ from all earlier ones, ``which`` gives every span its place
    in ``first``. Hashes (the spans' ``span_hash``) only propose equal spans;
    their bytes are compared."""
    if hashes is None:
        hashes = span_hash(prefix_hashes(text), start, stop)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    size, same = stop - start, first[which]
    differs = size != size[same]
    rows = np.flatnonzero(~differs & (same != np.arange(len(same))))
    differs[rows] = ~equal_spans(text, start[rows], text, start[same[rows]], size[rows])
    if differs.any():  # one hash, several strings
        others: dict[bytes, int] = {}
        more = []
        for i in np.flatnonzero(differs).tolist():
            key = text[start[i]:stop[i]].tobytes()
            if key not in others:
                others[key] = len(first) + len(more)
                more.append(i)
            which[i] = others[key]
        first = np.concatenate((first, more))
    return first, which


def pieces(text: bytes):
    """The text in pieces of about CHUNK bytes that end at white space."""
    at = 0
    while at < len(text):
        cut = _space.search(text, at + CHUNK) if len(text) - at > CHUNK else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


LONGEST = 64  # bytes of a word that are hashed by table


@lru_cache(2)
def _word_table(seed: int) -> np.ndarray:
    """A random number for every (place in a word, byte)."""
    return np.random.default_rng(seed).integers(0, 1 << 64, LONGEST << 8, np.uint64)


def word_hashes(text: bytes, lower: bool = True, seed: int = 0) -> np.ndarray:
    """Hash of each word (no ASCII white space inside), A-Z lower-cased: the
    sum of random numbers drawn from ``seed`` for its bytes and their places;
    a keyed digest for words of more than LONGEST bytes. With a seed that is
    not known beforehand no two words can be made to collide."""
    table, out = _word_table(seed), []
    for piece in pieces(text):
        b = np.frombuffer(piece, np.uint8)
        if lower:
            b = np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
        inside = ~SPACE[b]
        edge = np.diff(np.concatenate(([0], inside, [0])).astype(np.int8))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        begun = np.concatenate(([0], start))  # of the word a byte is in or after
        place = np.arange(len(b)) - np.repeat(begun, np.diff(np.append(begun, len(b))))
        value = table[np.minimum(place, LONGEST - 1) << 8 | b]
        value[~inside] = 0
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
        h = total[stop] - total[start]
        for i in np.flatnonzero(stop - start > LONGEST).tolist():
            key = seed.to_bytes(16, "little")
            h[i] = int.from_bytes(hashlib.blake2b(b[start[i]:stop[i]].tobytes(), digest_size=8, key=key).digest(), "little")
        out.append(h)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_set(text: bytes, k: int, seed: int = 0) -> np.ndarray:
    """Sorted distinct hashes of the text's ``k``-word shingles; a text of
    fewer words has its whole sequence as one, a text without words none."""
    w = word_hashes(text, seed=seed)
    if not len(w):
        return w
    n = min(k, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for j in range(n):
        h = mixed(h * np.uint64(BASE) + w[j:len(w) - n + 1 + j])
    return np.unique(h)
