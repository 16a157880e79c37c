"""Fill-in-middle transformation with a wavelet matrix.

A text is a sequence of units: runs of ASCII letters, and every other code
point by itself. Each code point gets a symbol: its character class (other,
space, digit, letter), and whether it goes on with the class of the code
point before it. A wavelet matrix over these symbols answers, for any
position, how many code points of a class begin a run and how many go on with
one. A boundary count, the number of units that begin before a position, is a
sum of such ranks: the beginnings of the classes that form runs (`joins`),
and all code points of the others. A cut after u units is where unit u
begins, found by bisection on the boundary count.

The texts of a batch are laid end to end and share one matrix; counts and
cuts of all of them are computed at once. Cuts, form and order come from the
SHA-256 of ``salt`` and the id, so a row is transformed alike wherever and
whenever it is.

Forms: psm ``<P>prefix<S>suffix<M>middle``, spm ``<S>suffix<P>prefix<M>middle``,
and plain, the text as it is. `restored` gives the text back from form and
output.

Defined cases: a null or empty text has no units and is plain; a text that
holds a marker is plain, since its marker could not be told from one put in;
a text of any length is transformed whole; repeated rows give equal results;
a null id is hashed as an empty string; bytes that are not UTF-8 each count
as one code point and come back unchanged; an empty table gives no rows;
other columns are left behind, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts
from .wavelet import WaveletMatrix

MARKERS = ("<P>", "<S>", "<M>")
CLASSES = ("other", "space", "digit", "letter")
_ascii = np.zeros(128, np.uint8)
_ascii[[0x20, *range(0x09, 0x0E)]] = 1
_ascii[48:58] = 2
_ascii[65:91] = _ascii[97:123] = 3


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def symbols_of(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Class and, in the lowest bit, whether a code point goes on with the
    class of the one before it. ``begins``: where texts begin."""
    kind = np.where(points < 128, _ascii[np.minimum(points, 127)], 0).astype(np.uint8)
    on = np.zeros(len(points), np.uint8)
    on[1:] = kind[1:] == kind[:-1]
    on[begins[begins < len(points)]] = 0
    return kind << 1 | on


class Units:
    """Units of the texts laid end to end in ``points``; text i is
    [edges[i], edges[i + 1])."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, joins: tuple[str, ...]):
        self.matrix, self.edges = WaveletMatrix(symbols_of(points, edges[:-1]), 3), edges
        self.beginnings = [k << 1 for k in range(4)] + [k << 1 | 1 for k in range(4) if CLASSES[k] not in joins]
        self.before = self.matrix.count(self.beginnings, edges)

    def counts(self) -> np.ndarray:
        return np.diff(self.before)

    def cut(self, after: np.ndarray) -> np.ndarray:
        """Code points of each text in its first ``after`` units."""
        low, high = self.edges[:-1], self.edges[1:]
        return self.matrix.select(self.beginnings, self.before[:-1] + after + 1, low, high) - low


def draws(doc_id: Column, salt: str) -> Column:
    """The first four 8-digit groups of the SHA-256 as numbers."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def transform(raw: list[bytes], h: np.ndarray, plain_share: int, spm_share: int,
              joins: tuple[str, ...]) -> list[tuple[int, str, int | None, int | None, bytes]]:
    """(units, form, prefix, middle, output) of each text; ``h``: its draws."""
    decoded = [t.decode("utf-8", "surrogateescape") for t in raw]
    points = code_points("".join(decoded))
    edges = np.concatenate(([0], np.cumsum([len(t) for t in decoded]))).astype(np.int64)
    units = Units(points, edges, joins)
    n = units.counts()
    u, v = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    first, second = units.cut(np.minimum(u, v)).tolist(), units.cut(np.maximum(u, v)).tolist()
    out = []
    for text, t, k, a, b, plain, spm in zip(raw, decoded, n.tolist(), first, second,
                                            (h[:, 2] % 100 >= 100 - plain_share).tolist(),
                                            (h[:, 3] % 100 < spm_share).tolist()):
        if not t or plain or any(m in t for m in MARKERS):
            out.append((k, "plain", None, None, text))
            continue
        prefix, middle, suffix = t[:a], t[a:b], t[b:]
        parts = ("<S>", suffix, "<P>", prefix) if spm else ("<P>", prefix, "<S>", suffix)
        whole = "".join((*parts, "<M>", middle)).encode("utf-8", "surrogateescape")
        out.append((k, "spm" if spm else "psm", a, b - a, whole))
    return out


def fill_in_middle(docs: DataFrame, salt: str = "1:", plain_share: int = 10, spm_share: int = 20,
                   joins: tuple[str, ...] = ("letter",)) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` per row:
    ``plain_share`` of 100 texts stay plain and ``spm_share`` of 100 others
    have the suffix first; code points of the classes ``joins`` form runs."""
    source = texts(docs).select("doc_id", "text", draws(F.col("doc_id"), salt).alias("h"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        h = np.array(batch.column("h").flatten()).reshape(-1, 4)
        rows = transform(batch.column("text").to_pylist(), h, plain_share, spm_share, joins)
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, types)]],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return map_batches(source, run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                                    "output binary")


def restore(output: bytes, form: str) -> bytes:
    if form == "plain":
        return output
    first, second = (b"<S>", b"<P>") if form == "spm" else (b"<P>", b"<S>")
    one, rest = output[len(first):].split(second, 1)
    two, middle = rest.split(b"<M>", 1)
    return two + middle + one if form == "spm" else one + middle + two


def restored(transformed: DataFrame) -> DataFrame:
    """The rows of `fill_in_middle` (form, output and any other columns) with
    ``text`` (binary), rebuilt from form and output alone."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in transformed.schema.fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts_ = [restore(o, f) for o, f in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist())]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts_, pa.binary())],
                                          [*batch.schema.names, "text"])
    return map_batches(transformed, run, f"{schema}, text binary")
