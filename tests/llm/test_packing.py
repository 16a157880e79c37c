"""Best-fit packing: sound placement, dominance, few sequences."""

import random
import zlib
from functools import lru_cache

import numpy as np
from helpers import clashing, docs, empty, odd_rows

from tablewise.llm import packing, tokens


def placed(histogram, capacity):
    p = packing.plan(histogram, capacity)
    lengths = sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True)
    room = {}
    for rank, x in enumerate(lengths):
        run = int(np.searchsorted(p.rank, rank, "right")) - 1
        assert p.length[run] == x
        sequence, slot = divmod(rank - int(p.rank[run]), int(p.per_sequence[run]))
        room.setdefault(int(p.sequence[run]) + sequence, []).append((int(p.offset[run]) + slot * x, x))
    for parts in room.values():
        at = 0
        for offset, x in sorted(parts):
            assert offset == at
            at += x
        assert at <= capacity
    assert sorted(room) == list(range(p.sequences))
    return p.sequences


def optimum(lengths, capacity):
    @lru_cache(None)
    def least(left):
        if not left:
            return 0
        first, rest = left[0], left[1:]
        best = len(left)

        def fill(room, i, taken):
            nonlocal best
            remaining = tuple(x for k, x in enumerate(rest) if k not in taken)
            best = min(best, 1 + least(remaining))
            for k in range(i, len(rest)):
                if rest[k] <= room:
                    fill(room - rest[k], k + 1, taken | {k})
        fill(capacity - first, 0, frozenset())
        return best
    return least(tuple(sorted(lengths, reverse=True)))


def test_placement_is_sound_and_near_the_bound():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.randint(4, 50)
        h = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
        n = placed(h, capacity)
        total = sum(x * k for x, k in h.items())
        assert -(-total // capacity) <= n <= 2 * total / capacity + 1
    big = {x: rng.randint(0, 40) for x in range(1, 4097)}
    assert placed({x: n for x, n in big.items() if n}, 4096) <= sum(x * n for x, n in big.items()) / 4096 * 1.01 + 1
    assert packing.plan({}, 16).sequences == 0


def test_fixed_sets_keep_an_optimum():
    """Taking a dominating set out leaves an instance that needs exactly one
    sequence fewer."""
    rng = random.Random(3)
    fixed = 0
    for _ in range(150):
        capacity = rng.randint(6, 14)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(2, 8))]
        counts = np.bincount(lengths, minlength=capacity + 1)
        for j in sorted(set(lengths), reverse=True):
            found = packing.dominating_set(counts, j, capacity)
            if found:
                rest = list(lengths)
                for x in found:
                    rest.remove(x)
                assert sum(found) <= capacity
                assert optimum(rest, capacity) + 1 == optimum(lengths, capacity), (capacity, lengths, found)
                fixed += 1
    assert fixed > 100


def test_pieces_and_places_of_a_table(spark):
    rows = odd_rows()
    capacity = 512
    out = packing.pack(clashing(docs(spark, rows)), capacity=capacity).collect()
    enc = tokens.encoder(tokens.default_vocabulary())
    want = []
    for i, t in rows:
        ids = enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((-1 if i is None else i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
                  for r in out) == sorted(want)
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == np.concatenate(([0], np.cumsum([n for _, n in parts])[:-1])).tolist()
        assert sum(n for _, n in parts) <= capacity
    assert packing.pack(empty(spark)).count() == 0
