import random
import zlib
from collections import defaultdict

import numpy as np

from boardroll.llm import sharding


def check(rows, texts, shards):
    by = defaultdict(list)
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by[r.shard].append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return by


def test_balance_slots_and_groups(documents):
    dice = random.Random(9)
    texts = {k: " ".join("w" * dice.randint(1, 9) for _ in range(dice.randint(0, 80))) for k in range(4000)}
    texts |= {4000 + k: "a very common copy" for k in range(2000)}
    texts |= {7000 + k: f"pair {k // 2}" for k in range(400)} | {9000: None, 9001: "", 9002: "long " * 2000}
    rows = sharding.shard_documents(documents(*texts.items()), 6).collect()
    by = check(rows, texts, 6)
    sizes = np.array([sum(r.size for r in by[s]) for s in range(6)])
    counts = np.array([len(by[s]) for s in range(6)])
    assert sizes.max() < 1.02 * sizes.min() and counts.max() < 1.1 * counts.min()
    where = {r.doc_id: r.shard for r in rows}
    assert all(where[7000 + 2 * k] == where[7001 + 2 * k] for k in range(200))  # a small group stays whole
    assert len({where[k] for k in range(4000, 6000)}) == 6  # a third of all rows does not


def test_blocks_agree_in_sum(spark, documents):
    dice = random.Random(7)
    texts = {k: f"{k} " + "x" * dice.randint(0, 400) for k in range(3000)}
    docs = documents(*texts.items())
    rows = docs.selectExpr(
        "doc_id AS rid", "doc_id", "octet_length(text) + 8L AS size", "2L AS tokens", "unhex(md5(text)) AS grp"
    )
    out = sharding.assign(rows, 4, fine=10, block_rows=200).collect()
    sizes = np.bincount([r.shard for r in out], [r["size"] for r in out], 4)
    assert len(out) == 3000 and sizes.max() < 1.02 * sizes.min()


def test_nulls_repeats_few_rows_and_empty_table(documents):
    docs = documents((None, "a"), (None, "a"), (1, "b"), (1, "b"), (2, None))
    rows = sharding.shard_documents(docs).collect()
    assert sorted((r.shard, r.slot) for r in rows) == sorted(set((r.shard, r.slot) for r in rows))
    assert len(rows) == 5
    assert sharding.shard_documents(docs.where("false")).count() == 0


def test_dot_product_rule():
    shard, taken = sharding.place(np.array([[6.0, 0, 0], [0, 6.0, 0], [1.0, 0, 0]]), np.array([[5.0, 5, 5], [9, 1, 5]]))
    assert shard.tolist() == [1, 0, 0] and taken[1, 0] == 6


def test_placing_against_plain_loops():
    """Largest group first, to the shard of the greatest dot product with what it still takes."""
    dice = random.Random(11)
    for n in (0, 1, 40):
        groups = [[float(dice.randint(0, 50)) for _ in range(3)] for _ in range(n)]
        capacity = [[sum(g[d] for g in groups) / 5 for d in range(3)] for _ in range(5)]
        mean = [max(sum(c[d] for c in capacity) / 5, 1e-12) for d in range(3)]
        scale = [w**0.5 / m for w, m in zip(sharding.WEIGHTS, mean, strict=True)]
        room = [[c[d] * scale[d] for d in range(3)] for c in capacity]
        want = [0] * n
        for k in sorted(range(n), key=lambda k: -max(groups[k][d] * scale[d] for d in range(3))):
            need = [groups[k][d] * scale[d] for d in range(3)]
            dots = [sum(a * b for a, b in zip(r, need, strict=True)) for r in room]
            want[k] = max(range(5), key=lambda s: (round(dots[s], 9), -s))
            room[want[k]] = [a - b for a, b in zip(room[want[k]], need, strict=True)]
        got, taken = sharding.place(np.array(groups).reshape(n, 3), np.array(capacity))
        assert got.tolist() == want
        assert all(taken[s].tolist() == [sum(groups[k][d] for k in range(n) if want[k] == s) for d in range(3)] for s in range(5))
