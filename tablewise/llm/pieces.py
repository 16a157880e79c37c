"""SentencePiece models on the tokenizers library.

The model file's protobuf is parsed and rebuilt as a `tokenizers` object:
normaliser (character map, dummy prefix, white-space marker), unigram scores
or BPE merges in score order, byte fallback, and the matching decoder. Texts
are encoded in batches by the library's threads (``threads`` per Spark task;
set it to the cores a task owns). Ids are decoded by gathering the bytes of
their pieces; where these are no UTF-8 (byte pieces in an order no text has)
the library's decoder has its say.

No piece of a usual model holds the white-space marker after another
character, and none holds a line break; then the ids of a text are those of
its chunks (a run of markers and the word after it; a line break and the word
after it). Chunks recur, so each Python worker encodes a chunk once and keeps
its ids in a cache of fixed size. Models for which this does not hold, and
texts that hold the marker itself, are encoded whole.

Parity: the sentencepiece library encodes every whole text too, and
``parity`` says whether the ids are the same; ``round_trip`` says whether the
decoded ids are the normalised text.

Defined cases: null and empty texts have no ids and round-trip; very long
texts are encoded whole; repeated rows are encoded each, and no order among
rows matters, so there are no ties; bytes that are no UTF-8 are replaced
before encoding; columns other than ``doc_id`` and ``text`` are left behind,
so their names cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, texts

MARK = "▁"
_MARK = MARK.encode()
CACHE_CHUNKS = 1_000_000
JOINED = 16
# Fixed values of the model format: model and piece types.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def score_merges(scores: dict[str, float]) -> list[tuple[str, str]]:
    """BPE merges: all splits of a piece into two pieces, by falling score."""
    merges = []
    for i, (piece, score) in enumerate(scores.items()):
        merges += [(-score, i, piece[:k], piece[k:]) for k in range(1, len(piece))
                   if piece[:k] in scores and piece[k:] in scores]
    return [(a, b) for _, _, a, b in sorted(merges)]


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, spec = list(proto.pieces), proto.normalizer_spec
        fallback = bool(proto.trainer_spec.byte_fallback)
        unknown = next(i for i, p in enumerate(pieces) if p.type == UNKNOWN)
        scores = {p.piece: p.score for p in pieces if p.type in (NORMAL, USER)}
        if proto.trainer_spec.model_type == UNIGRAM:
            model = models.Unigram([(p.piece, p.score) for p in pieces], unknown, fallback)
        elif proto.trainer_spec.model_type == BPE:
            model = models.BPE({p.piece: i for i, p in enumerate(pieces)}, score_merges(scores),
                               unk_token=pieces[unknown].piece, fuse_unk=True, byte_fallback=fallback)
        else:
            raise ValueError("unigram and BPE models only")
        steps = []
        if spec.precompiled_charsmap:
            steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
        if spec.remove_extra_whitespaces:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        self.clean = normalizers.Sequence(steps) if steps else None
        marks = [normalizers.Prepend(MARK)] if spec.add_dummy_prefix else []
        marks.append(normalizers.Replace(" ", MARK))
        self.whole = Tokenizer(model)
        self.whole.normalizer = normalizers.Sequence(steps + marks)
        self.whole.decoder = decoders.Sequence(
            [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
            + ([decoders.Strip(" ", 1, 0)] if spec.add_dummy_prefix else []))
        self.chunks = Tokenizer(model)  # encodes chunks that carry their markers
        self.prefix = bool(spec.add_dummy_prefix)
        self.split = (self.prefix and proto.trainer_spec.model_type == BPE
                      and not any(MARK in p.lstrip(MARK) or "\n" in p for p in scores))
        self.cache: dict[bytes, bytes] = {}
        # Bytes of every piece, one after the other, for decoding.
        raw = [bytes([int(p.piece[3:5], 16)]) if fallback and p.type == BYTE else p.piece.replace(MARK, " ").encode()
               for p in pieces]
        self.piece_size = np.array([len(r) for r in raw])
        self.marked_size = np.array([len(r) if p.type == BYTE else len(p.piece.encode()) for p, r in zip(pieces, raw)])
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)

    @staticmethod
    def cut(text: bytes) -> list[bytes]:
        """Chunks of a text. A chunk without a leading space stands for the
        marker and itself, unless it begins with a line break; one with
        leading spaces has a marker for each."""
        out: list[bytes] = []
        for k, line in enumerate(text.split(b"\n")):
            words = line.split(b" ")
            if k:
                words[0] = b"\n" + words[0]
            if b"" in words:
                spaces = 0
                for j, w in enumerate(words):
                    spaces += j > 0 or k == 0  # the dummy prefix counts as a space
                    if w:
                        out.append(w if w[0] == 10 or spaces == 1 else b" " * spaces + w)
                        spaces = 0
                if spaces:
                    out.append(b" " * spaces)
            else:
                out += words
        return out

    def learn(self, new: list[bytes]) -> None:
        """Encode chunks in one multithreaded batch, keep the ids. Chunks of a
        text are encoded alone or together alike, so JOINED of them are one
        text, and the lengths of the pieces tell their ids apart: where no piece spans two chunks, no merge did."""
        given = [w.replace(b" ", _MARK) if w[0] in b" \n" else _MARK + w for w in new]
        groups = [range(i, min(i + JOINED, len(new))) for i in range(0, len(new), JOINED)]
        single = []
        for some, ids in zip(groups, self._ids([b"".join(given[g.start:g.stop]) for g in groups])):
            reached = np.cumsum(self.marked_size[ids])
            ends = np.cumsum([len(given[i]) for i in some])
            last = np.searchsorted(reached, ends)
            if len(ids) and reached[-1] == ends[-1] and (reached[last] == ends).all():
                raw, at = ids.tobytes(), 0
                for i, stop in zip(some, (4 * (last + 1)).tolist()):
                    self.cache[new[i]] = raw[at:stop]
                    at = stop
            else:  # an unknown piece, whose bytes are not known
                single += some
        for i, ids in zip(single, self._ids([given[i] for i in single])):
            self.cache[new[i]] = ids.tobytes()

    def _ids(self, given: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in
                self.chunks.encode_batch_fast([g.decode() for g in given], add_special_tokens=False)]

    def encode(self, batch: list[str]) -> list[bytes]:
        """Ids of each text (little-endian uint32)."""
        if self.clean:
            batch = [self.clean.normalize_str(t) for t in batch]
        ids = [b""] * len(batch)
        whole = [i for i, t in enumerate(batch) if not self.split or MARK in t]
        if len(whole) < len(batch):
            cut = [[] if not t or not self.split or MARK in t else self.cut(t.encode()) for t in batch]
            if len(self.cache) > CACHE_CHUNKS:
                self.cache.clear()
            get, late = self.cache.__getitem__, []
            for i, c in enumerate(cut):
                try:
                    ids[i] = b"".join(map(get, c))
                except KeyError:
                    late.append(i)
            if late:
                self.learn(list(set().union(*(cut[i] for i in late)).difference(self.cache)))
                for i in late:
                    ids[i] = b"".join(map(get, cut[i]))
        if whole:
            for i, e in zip(whole, self.whole.encode_batch([batch[i] for i in whole], add_special_tokens=False)):
                ids[i] = np.array(e.ids, "<u4").tobytes()
        return ids

    def parity(self, batch: list[str], ids: list[bytes]) -> list[bool]:
        """Whether the sentencepiece library gives these ids for the whole texts."""
        return [array("I", self.reference.encode(t)).tobytes() == i for t, i in zip(batch, ids)]

    def decode(self, batch: list[bytes]) -> list[str]:
        """Texts of ids."""
        out: list[str | None] = []
        for b in batch:
            ids = np.frombuffer(b, "<u4")
            size = self.piece_size[ids]
            ends = np.cumsum(size)
            at = np.repeat(self.piece_start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ids) else 0)
            try:
                text = self.piece_bytes[at].tobytes().decode()
            except UnicodeDecodeError:
                out.append(None)
                continue
            out.append(text[1:] if self.prefix and text[:1] == " " else text)
        odd = [i for i, t in enumerate(out) if t is None]
        if odd:
            lists = [np.frombuffer(batch[i], "<u4").tolist() for i in odd]
            for i, t in zip(odd, self.whole.decode_batch(lists, skip_special_tokens=False)):
                out[i] = t
        return out


_codecs: dict[tuple[str, int], PieceCodec] = {}


def codec(path: str, threads: int = 2) -> PieceCodec:
    """This Python worker's codec for a model file."""
    if (path, threads) not in _codecs:
        _codecs[path, threads] = PieceCodec(path, threads)
    return _codecs[path, threads]


def encode_texts(docs: DataFrame, model: str | None = None, threads: int = 2) -> DataFrame:
    """``(doc_id, ids, n_tokens, parity, round_trip)``; ``ids`` is binary
    (little-endian uint32)."""
    model = model or default_model()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(model, threads)
        part = [t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]
        ids = c.encode(part)
        wanted = [(c.clean.normalize_str(t) if c.clean else t).replace(MARK, " ") for t in part]
        back = [x == y for x, y in zip(c.decode(ids), wanted)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
             pa.array(c.parity(part, ids), pa.bool_()), pa.array(back, pa.bool_())], ["doc_id", "ids", "n_tokens", "parity", "round_trip"])
    return map_batches(texts(docs), run,
                       "doc_id long, ids binary, n_tokens long, parity boolean, round_trip boolean")


def decode_ids(encoded: DataFrame, model: str | None = None, threads: int = 2) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``."""
    model = model or default_model()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [b or b"" for b in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codec(model, threads).decode(ids), pa.string())],
                                          ["doc_id", "text"])
    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")
