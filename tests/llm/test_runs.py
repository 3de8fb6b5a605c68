import hashlib
import random
import zlib

import numpy as np
import pytest

from boardroll.llm import queries
from boardroll.llm.runs import collapsed, find_runs, looped, numbered, repeats, runs_of, strongest, words_of


def slow_runs(words, least=24, times=3):
    """Every period at every place: stretches that no neighbour extends, smallest period only."""
    ids = np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if len(words) else np.empty(0)
    found = {}
    for q in range(1, len(words) // times + 1):
        same = np.concatenate(([0], (ids[:-q] == ids[q:]).astype(int), [0]))
        starts, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            if e - s + q >= max(least, times * q):
                found.setdefault((s, e - s + q), q)  # a multiple of a smaller period spans the same
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda run: (run[0], run[2]))


def slow_looped(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def woven(seed, n, letters, patches):
    """Random words with copied stretches of short periods."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(letters)}" for _ in range(n)]
    for _ in range(patches if n else 0):
        at, period, size = draw.randrange(n), draw.randint(1, 12), draw.randint(1, 80)
        for i in range(at + period, min(n, at + period + size)):
            words[i] = words[i - period]
    return words


@pytest.mark.parametrize("least,times", [(24, 3), (6, 3), (8, 2), (12, 4)])
def test_runs_against_brute_force(least, times):
    for seed in range(250):
        words = woven(seed, seed % 130, (1, 2, 3, 50)[seed % 4], seed % 5)
        got = runs_of(numbered([w.encode() for w in words]), least, times)
        assert got == slow_runs(words, least, times), (seed, words)


def test_strongest_and_collapse():
    words = [b"x", *[b"a", b"b"] * 12, b"y", *[b"c"] * 30, b"z"]
    runs = runs_of(numbered(words))
    assert runs == [(1, 24, 2), (26, 30, 1)]
    assert strongest(runs) == (26, 30, 1) and strongest([]) is None
    assert strongest([(0, 30, 10), (40, 36, 12), (90, 24, 8)]) == (0, 30, 10)  # all three periods: first start
    assert collapsed(words, runs) == b"x a b y c z"
    assert collapsed(words, []) == b" ".join(words)


def test_repeats_never_misses():
    for seed in range(200):
        words = [w.encode() for w in woven(seed, 90, 3, 2)]
        grams = [tuple(words[i : i + 7]) for i in range(len(words) - 6)]
        assert repeats(numbered(words), 7) >= (len(set(grams)) < len(grams))


def test_long_texts_take_no_quadratic_time():
    assert runs_of(numbered([b"a"] * 60_000)) == [(0, 60_000, 1)]
    boiler = [w for i in range(2000) for w in [b"x%d" % i, *[b"w%d" % k for k in range(20)]]]
    assert runs_of(numbered(boiler)) == []


def test_rows_nulls_and_clashing_columns(documents):
    run = " ".join(["to", "be"] * 20)
    docs = documents((1, f"so {run}"), (1, f"so {run}"), (2, None), (3, ""), (None, run), (4, " \t\r\n "), (5, "né " * 30))
    got = sorted(map(tuple, find_runs(docs).collect()), key=str)
    by_id = {}
    for row in got:
        by_id.setdefault(row[0], []).append(row[1:])
    # "so" does not end in the run's period, so the run starts after it.
    assert by_id[1] == [(41, [(1, 40, 2)], (1, 40, 2), "so to be")] * 2
    assert by_id[2] == by_id[3] == by_id[4] == [(0, [], None, "")]
    assert by_id[None] == [(40, [(0, 40, 2)], (0, 40, 2), "to be")]
    assert by_id[5] == [(30, [(0, 30, 1)], (0, 30, 1), "né")]
    assert find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        find_runs(docs, times=1)


def test_looped_texts(documents):
    texts = {k: " ".join(woven(k, k % 60, 500, 0)) for k in range(300)}
    got = {r["doc_id"]: r["text"] for r in looped(documents(*texts.items())).collect()}
    assert {k: t.split() for k, t in got.items()} == {k: slow_looped(k, t.split()) for k, t in texts.items()}
    odd = looped(documents((5, None), (None, "a  b"), (7, "")))
    assert {(r[0], r[1]) for r in odd.collect()} == {(5, None), (None, "a  b"), (7, "")}


def test_query_against_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for doc_id, text in docs:
        words = slow_looped(doc_id, [w.decode() for w in words_of(text or "")])
        runs, row = slow_runs(words), got[doc_id]
        some += bool(runs)
        assert row["n_runs"] == len(runs)
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        assert (row["start"], row["length"], row["period"]) == top
        assert row["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        assert row["collapsed_sha256"] == hashlib.sha256(left.encode()).hexdigest()
    assert some > 5
