"""Token ids of whole texts with a byte-level BPE vocabulary.

Its splitting rule ends a token before white space that follows a character
other than white space (a single space belongs to the word after it), and
between a letter and punctuation other than an apostrophe. A text's ids are
the ids of its parts cut at such places, so each Python worker encodes a part
once (see `tokens`). Cuts are made where the bytes alone prove them right:
before ASCII white space after a printable ASCII character or a two-byte
letter (lead byte C3 or more, which leaves out the two-byte white space), and
before punctuation after an ASCII letter.

Texts that hold the vocabulary's special string are encoded as they stand.

New parts that are a space and a word of Latin letters are encoded many at
once, as one text that this rule cuts into them; a token's length in bytes is
that of its name, so the ids are told apart by the parts' lengths.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np

from . import tokens
from .hashing import CHUNK, SPACE

SPECIAL = b"<|endoftext|>"
BATCH = 20_000
JOINED = 500
# Punctuation that never shares a token with a letter before it.
PUNCTUATION = tokens.PUNCTUATION
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
PRINTABLE = np.zeros(256, bool)
PRINTABLE[0x21:0x7F] = True
_break = re.compile(rb"[!-~][ \t-\r]")
_word = re.compile(rb" (?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about CHUNK bytes that end where a part ends."""
    at = 0
    while at < len(text):
        cut = _break.search(text, at + CHUNK) if len(text) - at > CHUNK else None
        end = cut.start() + 1 if cut else len(text)
        yield text[at:end]
        at = end


class ByteEncoder(tokens.WordEncoder):
    """Ids of texts as little-endian uint32 bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.token_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]  # a character stands for a byte
        self._forget()

    def _learn(self, parts: list[bytes]) -> None:
        words, single = [], []
        for p in parts:
            (words if _word.fullmatch(p) else single).append(p)
        for at in range(0, len(words), BATCH):
            groups = [words[i:i + JOINED] for i in range(at, min(at + BATCH, len(words)), JOINED)]
            done, arrays, lengths = [], [], []
            for some, found in zip(groups, self._ids([b"".join(g) for g in groups])):
                ids = np.array(found, "<u4")
                reached = np.cumsum(self.token_bytes[ids])
                ends = np.cumsum([len(p) for p in some])
                last = np.searchsorted(reached, ends)
                if reached[-1] == ends[-1] and (reached[last] == ends).all():
                    done += some
                    arrays.append(ids)
                    lengths += np.diff(last, prepend=-1).tolist()
                else:  # a token spans two parts
                    single += some
            if done:
                self._keep(done, arrays, lengths)
        for at in range(0, len(single), BATCH):
            some = single[at:at + BATCH]
            found = self._ids(some)
            self._keep(some, [np.fromiter(chain.from_iterable(found), "<u4")], [len(i) for i in found])

    def _ids(self, parts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in parts],
                                                                add_special_tokens=False)]

    def _cut(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        buf = np.frombuffer(b"\n".join(texts), np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(size + 1) - 1
        begins = ends - size
        space = SPACE[buf]
        safe = PRINTABLE[buf]
        two = np.zeros(len(buf), bool)  # last byte of a two-byte letter
        two[1:] = (buf[1:] >= 0x80) & (buf[:-1] >= 0xC3) & (buf[:-1] < 0xE0)
        cut = np.zeros(len(buf) + 1, bool)
        cut[1:-1] = space[1:] & (safe | two)[:-1] | LETTER[buf[:-1]] & PUNCTUATION[buf[1:]]
        cut[ends] = False  # the line ends between texts
        cut[begins[size > 0]] = True
        start = np.flatnonzero(cut)
        owner = np.searchsorted(begins, start, "right") - 1
        stop = np.minimum(np.append(start[1:], len(buf)), ends[owner])
        return buf, start, stop

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        at, size = 0, 0
        for i, t in enumerate(texts):
            if len(t) > tokens.SLICE_BYTES or SPECIAL in t:
                yield from self._slice(texts[at:i])
                if SPECIAL in t:
                    yield self._encode(t.decode("utf-8", "replace")).tobytes()
                else:
                    yield b"".join(self._slice([p])[0] for p in pieces(t))
                at, size = i + 1, 0
            elif size + len(t) > tokens.SLICE_BYTES:
                yield from self._slice(texts[at:i])
                at, size = i, len(t)
            else:
                size += len(t)
        yield from self._slice(texts[at:])


_encoders: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    """This Python worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
