"""Periodic runs of words: maximal pairs from the LCP-interval tree of each text.

A run is a stretch of words with smallest period p, at least ``least`` words and ``times``
periods long, that no neighbouring word extends. If it starts at s and is L words long, the
suffixes at s and s + p agree on exactly L - p words and the words before them differ: they
are a maximal pair. The other way round, a maximal pair at distance p whose common part has
l words spans a stretch of p + l words with period p that cannot be extended. So the runs are
the maximal pairs with l >= (times - 1) * p and p + l >= least; of pairs that span the same
stretch (multiples of its period) the smallest distance counts. Nothing is extended
afterwards.

Both conditions together ask for l >= least * (times - 1) / times, so only intervals of the tree
with at least so many common words matter. A rolling hash tells which texts repeat that
many words at all; the others have no run. For the rest the suffix array comes from prefix
doubling, the common lengths from the same ranks, and the tree's intervals are joined bottom
up. A node keeps its positions in order, and per left word the positions that it precedes.
Of two children the smaller looks up partners in the larger: a window of l / (times - 1) words
around each position, in the lists of other left words, or among the window's positions
where those are fewer. Two children's suffixes agree on exactly the node's length, so every
pair found is maximal, and each is found once.

Texts are independent: no shuffle. A task holds one text's ranks at a time, four bytes a word
for every doubling, of which there are as many as the longest repeat takes.

Defined results: a null text is empty and has no words and no runs; a null id is kept; repeated
rows get the same row twice; an empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from boardroll.llm.common import map_texts

_WHITE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_MIX = 0x9E3779B97F4A7C15
_RUN = [StructField(name, LongType()) for name in ("start", "length", "period")]
RUN = StructType(_RUN)


def words_of(text: str) -> list[bytes]:
    """Words between white space (space, tab to carriage return)."""
    return text.encode("utf-8", "replace").translate(_WHITE).split()


def numbered(words: list[bytes]) -> np.ndarray:
    """A number per word, equal for equal words."""
    return np.fromiter(map({}.setdefault, words, count()), np.int64, len(words))


def repeats(ids: np.ndarray, size: int) -> bool:
    """Whether some ``size`` words may occur twice; never False if they do."""
    if len(ids) <= size:
        return False
    mix, width = _MIX, 1
    hashed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(mix)
    hashed ^= hashed >> np.uint64(29)
    while 2 * width <= size:
        mix = (mix * mix + 2 * width) % (1 << 64)
        hashed, width = hashed[:-width] * np.uint64(mix) + hashed[width:], 2 * width
    if width < size:
        mix = mix * mix % (1 << 64)
        hashed = hashed[: width - size] * np.uint64(mix) + hashed[size - width :]
    hashed.sort()
    return bool((hashed[1:] == hashed[:-1]).any())


def suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all suffixes in order, and the words that each shares with the one before."""
    n, width = len(ids), 1
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int32)
    levels = [rank]
    while rank.max() < n - 1:
        follow = np.zeros(n, np.int64)
        follow[: n - width] = rank[width:] + 1
        rank = np.unique(rank * np.int64(n + 1) + follow, return_inverse=True)[1].astype(np.int32)
        levels.append(rank)
        width *= 2
    order = np.argsort(rank)
    one, two = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        # Ranks hold the end of the text, so equal ranks of two places mean whole equal words.
        rank = levels[level]
        inside = np.maximum(one, two) < n
        same = inside & (rank[np.minimum(one, n - 1)] == rank[np.minimum(two, n - 1)])
        step = same.astype(np.int64) << level
        shared[1:] += step
        one += step
        two += step
    return order, shared


class _Node:
    """Suffixes below an interval of the tree: all starts, and starts by the word before."""

    __slots__ = ("by_left", "starts")

    def __init__(self, start: int, left: int) -> None:
        self.starts = [start]
        self.by_left = {left: [start]}

    def take(self, other: _Node) -> None:
        """Add another node's suffixes."""
        for left, starts in other.by_left.items():
            mine = self.by_left.setdefault(left, [])
            for start in starts:
                insort(mine, start)
                insort(self.starts, start)

    def partners(self, start: int, left: int, reach: int) -> list[int]:
        """Starts within ``reach`` of ``start`` that another word precedes."""
        low, high = start - reach, start + reach
        first, end = bisect_left(self.starts, low), bisect_right(self.starts, high)
        if first == end:
            return []
        if end - first <= len(self.by_left):
            mine = self.by_left.get(left, ())
            near = set(mine[bisect_left(mine, low) : bisect_right(mine, high)]) if mine else ()
            return [s for s in self.starts[first:end] if s not in near]
        found = []
        for other, starts in self.by_left.items():
            if other != left:
                found += starts[bisect_left(starts, low) : bisect_right(starts, high)]
        return found


def runs_of(ids: np.ndarray, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of the numbered words, by start, then period."""
    floor = -(-least * (times - 1) // times)
    if len(ids) < least or not repeats(ids, floor):
        return []
    order, shared = suffixes(ids)
    before = np.concatenate(([-1], ids[:-1])).tolist()
    found: dict[tuple[int, int], int] = {}

    def joined(common: int, one: _Node, two: _Node) -> _Node:
        """Both children of an interval in one node; notes the maximal pairs between them."""
        small, large = (one, two) if len(one.starts) < len(two.starts) else (two, one)
        for left, starts in small.by_left.items():
            for start in starts:
                for other in large.partners(start, left, common // (times - 1)):
                    period = abs(start - other)
                    if period + common >= least:
                        span = min(start, other), period + common
                        found[span] = min(period, found.get(span, period))
        large.take(small)
        return large

    # Stretches of the order in which neighbours share enough words; the rest has no node.
    deep = np.flatnonzero(shared >= floor)
    cuts = np.flatnonzero(np.diff(deep) > 1) + 1
    for part in np.split(deep, cuts) if len(deep) else []:
        places = order[part[0] - 1 : part[-1] + 1].tolist()
        node, open_nodes = _Node(places[0], before[places[0]]), []
        for place, common in zip(places[1:], shared[part].tolist(), strict=True):
            while open_nodes and open_nodes[-1][0] > common:
                node = joined(*open_nodes.pop(), node)
            if open_nodes and open_nodes[-1][0] == common:
                node = joined(*open_nodes.pop(), node)
            open_nodes.append((common, node))
            node = _Node(place, before[place])
        while open_nodes:
            node = joined(*open_nodes.pop(), node)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda run: (run[0], run[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; of equals that of the smallest start, then period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by single spaces."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    starts, lengths, periods = np.array(runs, np.int64).T
    np.add.at(steps, starts + periods, 1)
    np.add.at(steps, starts + lengths, -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """doc_id, n_words, runs, strongest and collapsed for every row.

    ``runs`` is an array of (start, length, period) by start, then period; ``strongest`` the one
    with most periods, or null; ``collapsed`` the text with each run cut to its first period.
    """
    if times < 2 or least < times:
        raise ValueError("a run has at least two periods, and a word in each")

    def work():
        def apply(texts: list[str]) -> list[pa.Array]:
            sizes, all_runs, best, left = [], [], [], []
            for text in texts:
                words = words_of(text)
                runs = runs_of(numbered(words), least, times)
                sizes.append(len(words))
                all_runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                top = strongest(runs)
                best.append(top and dict(zip(("start", "length", "period"), top, strict=True)))
                left.append(collapsed(words, runs).decode("utf-8"))
            run = pa.struct([(f.name, pa.int64()) for f in _RUN])
            return [
                pa.array(sizes, pa.int64()), pa.array(all_runs, pa.list_(run)),
                pa.array(best, run), pa.array(left, pa.string()),
            ]

        return apply

    fields = [
        StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)),
        StructField("strongest", RUN), StructField("collapsed", StringType()),
    ]
    return map_texts(docs, work, fields)


def looped(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the checksum of its id, made periodic from some word on.

    With h = crc32 of the id as text and g = h div 10: if h mod 10 is 0, word i from a = g mod n
    on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Other texts, and
    those of null ids, stay as they are. Returns doc_id and text.
    """
    text, h = docs["text"].cast("string"), F.crc32(docs["doc_id"].cast("string").cast("binary"))
    changes = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")
    g = F.floor(h / 10).cast("long")
    at = docs.select("doc_id", text.alias("text"), F.when(changes, words).alias("w"), g.alias("g"))
    at = at.withColumn("n", F.size("w").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    at = at.withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    new = F.expr("array_join(transform(w, (x, i) -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return at.select("doc_id", F.when(F.col("n") > 0, new).otherwise(F.col("text")).alias("text"))
