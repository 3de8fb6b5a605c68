import random
from collections import defaultdict

import numpy as np

from boardroll.llm import packing

COSTS = {8: 8.0, 16: 17.0, 32: 38.0}


def check(rows, lengths, costs):
    """Every unit of every document lies in exactly one place, and bins do not overflow."""
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece_start, r.piece_length, r.n_units))
        bins[r.bin_id].append((r.bin_start, r.piece_length, r.capacity))
    assert set(pieces) == set(lengths)
    for doc, parts in pieces.items():
        at = 0
        for start, length, units in sorted(parts):
            assert start == at and units == lengths[doc]
            at += length
        assert at == lengths[doc]
    for parts in bins.values():
        at = 0
        for start, length, capacity in sorted(parts):
            assert start == at and capacity == parts[0][2]
            at += length
        assert at <= capacity
        assert capacity == min((c for c in costs if c >= at), key=lambda c: (costs[c], c))


def test_every_unit_is_placed_once(documents):
    dice = random.Random(8)
    texts = {k: " ".join("w" * dice.randint(0, 90)) for k in range(700)}
    texts |= {1000: None, 1001: "", 1002: "w " * 31, 1003: "w " * 32, 1004: "\t\n", 1005: "w " * 5000}
    lengths = {k: len((t or "").split()) + 1 for k, t in texts.items()}
    for block in (50, 100000):
        out = packing.pack(documents(*texts.items()), COSTS, block_rows=block)
        check(out.collect(), lengths, COSTS)


def test_repeated_and_null_ids_and_empty_table(documents):
    docs = documents((None, "a b"), (None, "a b"), (2**60 + 1, "c"), (2**60 + 1, "c"))
    out = packing.pack(docs, COSTS).collect()
    assert sorted((str(r.doc_id), r.n_units) for r in out) == [(str(2**60 + 1), 2)] * 2 + [("None", 3)] * 2
    assert packing.pack(docs.where("false")).count() == 0


def test_fit_is_tight():
    """Little room is lost, and no more cost than with the best single length."""
    rng = np.random.default_rng(3)
    lengths = np.sort(np.minimum(rng.lognormal(6, 1.2, 20000).astype(int) + 1, 8192))[::-1]
    numbers, _, capacity = packing.pack_block(lengths)
    held = np.bincount(numbers, lengths)
    assert (held <= capacity).all() and held.sum() > 0.97 * capacity.sum()
    cost = sum(packing.COSTS[c] for c in capacity.tolist())
    _, _, single = packing.pack_block(lengths, {8192: packing.COSTS[8192]})
    assert cost < 0.9 * len(single) * packing.COSTS[8192]
    bound = lengths.sum() * min(c / n for n, c in packing.COSTS.items())
    assert cost < 1.25 * bound


def slow_pack(lengths, costs):
    """Plain best fit: every open bin is looked at for every rest; (bin of each, contents of each bin)."""
    rooms, filled, stamps, where = [], [], [], []
    for k, length in enumerate(lengths):
        fitting = [b for b, room in enumerate(rooms) if room >= length]
        if fitting:  # the fullest; of equals the one that was filled last
            at = min(fitting, key=lambda b: (rooms[b], -stamps[b]))
        else:
            coming = sorted(lengths[k + 1 :], reverse=True)

            def worth(size, length=length, coming=coming):
                held, room, used, last = length, size - length, 0, None
                for rest in coming:
                    if rest <= room and (rest == last or used < 8):
                        used, last = used + (rest != last), rest
                        held, room = held + rest, room - rest
                return costs[size] / held, size

            at = len(rooms)
            rooms.append(min((s for s in costs if s >= length), key=worth))
            filled.append(0)
            stamps.append(0)
        rooms[at] -= length
        filled[at] += length
        stamps[at] = k
        where.append(at)
    return where, [min((s for s in costs if s >= f), key=lambda s: (costs[s], s)) for f in filled]


def test_blocks_against_a_plain_best_fit():
    rng = np.random.default_rng(12)
    for most in (4, 9, 20, 32):
        for n in (0, 1, 7, 60, 150):
            lengths = np.sort(rng.integers(1, most + 1, n))[::-1]
            numbers, _, capacity = packing.pack_block(lengths, COSTS)
            where, sizes = slow_pack(lengths.tolist(), COSTS)
            assert numbers.tolist() == where and capacity.tolist() == sizes, (most, n)
