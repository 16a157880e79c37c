"""Token ids of whole texts with the tokenizers library.

The vocabulary in use drops white space and never forms a token across it,
and its splitting rule ends a token between a letter and punctuation other
than an apostrophe. So a text's ids are the ids of its parts, cut at these
places, one after the other. Parts recur: each Python worker encodes a part
once and keeps its ids and its bytes, in a store of fixed size that starts
anew when it is full. Cutting, looking up and putting together are array
operations over a few megabytes of text. Parts are looked up by a hash; the
bytes are compared, and parts that share their hash with another one are
kept apart, under their bytes.

ASCII letters are lower-cased first (the vocabulary's normaliser does so
too). Texts that hold "<|", which starts the strings of special tokens, are
encoded as they stand: those strings are matched before normalisation.

New parts of Latin letters only are encoded many at once: each is one unit of
the splitting rule, and its last token, and no other, is one of the
vocabulary's word-end tokens.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np

from .hashing import SPACE, distinct_spans, equal_spans, pieces, prefix_hashes, span_hash

STORE_PARTS = 400_000
SLICE_BYTES = 1 << 20
JOINED = 500  # parts of a text
BATCH = 16  # texts of a call
BATCH_SINGLE = 2000
# Punctuation without the apostrophe, which can start a contraction.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[list(b".,;:!?%&*$#|")] = True
LAST_LATIN = 0xC9  # no larger byte: all code points are below U+0280
WORD_END = "</w>"


def _written(store: np.ndarray, values: np.ndarray, at: int) -> np.ndarray:
    """``store`` with the values from ``at`` on, made larger if it must be."""
    total = at + len(values)
    if total > len(store):
        store = np.concatenate((store[:at], np.empty(2 * total - at, store.dtype)))
    store[at:total] = values
    return store


class WordEncoder:
    """Ids of texts as little-endian uint32 bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith(WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}  # the parts learnt last -> their numbers
        self.keys = np.empty(0, np.uint64)  # hashes of parts, ascending
        self.place = np.empty(0, np.int64)  # and the parts' numbers
        self.clashing: dict[bytes, int] = {}  # parts whose hash is another part's -> their numbers
        self.bytes = np.empty(1 << 16, np.uint8)
        self.begin = np.zeros(1, np.int64)  # part n is bytes[begin[n]:begin[n + 1]]
        self.ids = np.empty(1 << 16, "<u4")
        self.first = np.zeros(1, np.int64)  # part n has ids[first[n]:first[n + 1]]

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _ids(self, parts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in parts],
                                                                add_special_tokens=False)]

    def _learn(self, parts: list[bytes]) -> None:
        joined, single = [], []
        for w in parts:
            if w.isalpha():  # ASCII letters
                joined.append(w)
                continue
            text = w.decode("utf-8", "replace")
            if max(w) <= LAST_LATIN and text.isalpha() and text.lower().isalpha():
                joined.append(w)
            else:
                single.append(w)
        groups = [joined[at:at + JOINED] for at in range(0, len(joined), JOINED)]
        for at in range(0, len(groups), BATCH):
            done, arrays, lengths = [], [], []
            for some, found in zip(groups[at:at + BATCH], self._ids([b" ".join(g) for g in groups[at:at + BATCH]])):
                ids = np.array(found, "<u4")
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) == len(some) and ends[-1] == len(ids):
                    done += some
                    arrays.append(ids)
                    lengths += np.diff(ends, prepend=0).tolist()
                else:  # some part became several units when it was normalised
                    single += some
            if done:
                self._keep(done, arrays, lengths)
        for at in range(0, len(single), BATCH_SINGLE):
            some = single[at:at + BATCH_SINGLE]
            found = self._ids(some)
            self._keep(some, [np.fromiter(chain.from_iterable(found), "<u4")], [len(i) for i in found])

    def _keep(self, parts: list[bytes], arrays: list[np.ndarray], lengths: list[int]) -> None:
        """Store parts with their ids, ``lengths`` of the joined ``arrays`` each."""
        n = len(self.first) - 1
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(lengths)))
        self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum([len(p) for p in parts])))
        self.ids = _written(self.ids, np.concatenate(arrays), int(self.first[n]))
        self.bytes = _written(self.bytes, np.frombuffer(b"".join(parts), np.uint8), int(self.begin[n]))
        self.number.update(zip(parts, range(n, n + len(parts))))

    def _numbers(self, buf: np.ndarray, start: np.ndarray, stop: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The numbers of different parts buf[start:stop]; new ones are learnt."""
        number = np.full(len(start), -1)
        at = np.searchsorted(self.keys, hashes)
        hit = np.flatnonzero(at < len(self.keys))
        hit = hit[self.keys[at[hit]] == hashes[hit]]
        kept, size = self.place[at[hit]], (stop - start)[hit]
        begin = self.begin[kept]
        alike = size == self.begin[kept + 1] - begin
        rows = np.flatnonzero(alike)
        alike[rows] = equal_spans(buf, start[hit[rows]], self.bytes, begin[rows], size[rows])
        number[hit[alike]] = kept[alike]
        if self.clashing:
            for i in hit[~alike].tolist():
                number[i] = self.clashing.get(buf[start[i]:stop[i]].tobytes(), -1)
        new = np.flatnonzero(number < 0)
        if len(new):
            raw = buf.tobytes()
            parts = [raw[i:j] for i, j in zip(start[new].tolist(), stop[new].tolist())]
            self.number = {}
            self._learn(parts)
            number[new] = [self.number[p] for p in parts]
            taken = np.zeros(len(start), bool)
            taken[hit] = True
            keys, row = np.unique(hashes[new], return_index=True)
            free = ~taken[new[row]]
            keys, row = keys[free], row[free]
            to = np.searchsorted(self.keys, keys)
            self.keys, self.place = np.insert(self.keys, to, keys), np.insert(self.place, to, number[new[row]])
            if len(row) < len(new):
                for i in np.setdiff1d(np.arange(len(new)), row).tolist():
                    self.clashing[parts[i]] = int(number[new[i]])
        return number

    def _cut(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts, joined by line ends, and where their parts start and stop."""
        buf = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        space = SPACE[buf]
        letter = (buf >= 97) & (buf <= 122)
        cut = np.concatenate(([True], space[:-1] | (letter[:-1] & PUNCTUATION[buf[1:]])))[:len(buf)]
        start = np.flatnonzero(cut & ~space)
        stop = np.flatnonzero(np.append(cut[1:] | space[1:], True)[:len(buf)] & ~space) + 1
        return buf, start, stop

    def _slice(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each of a few texts without special strings."""
        if len(self.first) > STORE_PARTS:
            self._forget()
        buf, start, stop = self._cut(texts)
        if not len(start):
            return [b""] * len(texts)
        hashes = span_hash(prefix_hashes(buf), start, stop)
        first, which = distinct_spans(buf, start, stop, hashes)
        part = self._numbers(buf, start[first], stop[first], hashes[first])[which]
        count = self.first[part + 1] - self.first[part]
        before = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.repeat(self.first[part] - before[:-1], count) + np.arange(before[-1])].tobytes()
        ends = np.cumsum([len(t) + 1 for t in texts])
        edge = 4 * before[np.searchsorted(start, np.concatenate(([0], ends)))]
        return [ids[x:y] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        at, size = 0, 0
        for i, t in enumerate(texts):
            if len(t) > SLICE_BYTES or b"<|" in t:
                yield from self._slice(texts[at:i])
                if b"<|" in t:
                    yield self._encode(t.decode("utf-8", "replace")).tobytes()
                else:  # a long text in pieces that end at white space
                    yield b"".join(self._slice([p])[0] for p in pieces(t))
                at, size = i + 1, 0
            elif size + len(t) > SLICE_BYTES:
                yield from self._slice(texts[at:i])
                at, size = i, len(t)
            else:
                size += len(t)
        yield from self._slice(texts[at:])


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This Python worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
