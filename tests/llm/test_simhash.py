import itertools
import random

import xxhash
from pyspark.sql import functions as F

from boardroll.llm import simhash


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits=3):
    names = list(range(len(prints)))

    def top(k):
        while names[k] != k:
            k = names[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                names[max(top(a), top(b))] = min(top(a), top(b))
    return [top(k) for k in range(len(prints))]


def _texts():
    dice = random.Random(3)
    words = [f"w{k}" for k in range(50)]
    base = [" ".join(dice.choice(words) for _ in range(n)) for n in (200, 400, 30, 5, 2, 1)]
    near = []
    for _ in range(60):  # a chain of ever more changed copies
        parts = (near[-1] if near else base[0]).split(" ")
        parts[dice.randrange(len(parts))] = "Changed"
        near.append(" ".join(parts))
    return [*base, *near, *base[:3], None, "", " \t\n\x0b", "A b\x0cC", "a B c", "é ü" * 500, "x" * 5000]


def test_against_brute_force(documents):
    texts = _texts()
    rows = {r.doc_id: r for r in simhash.near_duplicates(documents(*enumerate(texts))).collect()}
    prints = [slow_fingerprint(t) for t in texts]
    assert [rows[k].fingerprint for k in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [rows[k].component_id for k in range(len(texts))] == slow_components(prints)


def test_chunked_groups_lose_no_link(spark):
    dice = random.Random(4)
    prints = {dice.getrandbits(64)}
    while len(prints) < 300:  # a crowd in which all share some blocks
        prints.add(dice.choice(sorted(prints)) ^ (1 << dice.randrange(64)) ^ (1 << dice.randrange(12)))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(5)
    links = simhash.block_links(frame, chunk=16)
    found = {(r.a, r.b) for r in links.collect()}
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in found)
    assert len(found) < 300 * 299 // 8
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    got = [roots.get(s, s) for s in signed]
    slow = slow_components(prints)
    assert len(set(zip(got, slow, strict=True))) == len(set(got)) == len(set(slow))


def _crowd(n):
    """Distinct fingerprints within three bits of one, itself first: one component."""
    base = 0x0123456789ABCDEF
    flips = itertools.chain(*(itertools.combinations(range(64), k) for k in range(4)))
    prints = [base ^ sum(1 << b for b in chosen) for chosen in itertools.islice(flips, n)]
    return [p - (1 << 64) if p >> 63 else p for p in prints]


def test_a_crowd_of_near_copies_takes_linear_rows(spark):
    """20,000 different near copies of one text: groups stay small, rows grow with their number."""
    rows = {}
    for n in (5_000, 20_000):
        frame = spark.createDataFrame([(p,) for p in _crowd(n)], "fp long").repartition(8)
        groups = simhash.block_groups(frame).groupBy("mask", "held").count().agg(F.sum("count"), F.max("count")).first()
        rows[n] = groups[0]
        assert groups[1] <= 1024
    assert rows[20_000] <= 6 * rows[5_000] and rows[20_000] <= 20_000 * 400
    links = simhash.block_links(frame)
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    assert len(roots) == 19_999 and len(set(roots.values())) == 1  # all but the root itself


def test_choices_of_blocks_meet():
    dice = random.Random(8)
    for _ in range(300):
        free = dice.getrandbits(64) | 0x3F
        apart = sum(1 << b for b in dice.sample([b for b in range(64) if free >> b & 1], 3))
        assert any(not apart & mask for mask in simhash._choices(free, 6, 3))


def test_null_ids_and_empty_table(documents):
    docs = documents((None, "a b c d"), (None, "a b c d"), (7, "a b c d"), (None, "other words here now"), (8, None))
    got = sorted(
        ((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str
    )
    assert got == sorted([(None, 7), (None, 7), (7, 7), (None, None), (8, 8)], key=str)
    assert simhash.near_duplicates(docs.where("false")).count() == 0
