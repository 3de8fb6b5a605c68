"""Quality classifier: a generalised additive model with pairwise interactions.

Statistics of the whole text are cut into quantile bins. Rounds of boosting go through the
features in turn; each time a shallow tree over one feature's bins is fitted to what is
left over and added, damped, to that feature's lookup table. Then the most promising pairs
of features get tables of their own from shallow trees over two features. A score is the
sum of the table entries that a text's bins select, through the logistic function.

The model is fitted on a bounded sample of labelled documents (``per_class`` of each
class, weighted back to the true shares); every document is scored.

Defined results: a null text is empty and has all statistics zero; without labels every
score is 0.5, with labels of one class only every score is that class's smoothed share.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from boardroll.llm.common import class_weights, filter_texts, label_sample, map_texts, share

FEATURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "marks", "outside_ascii", "distinct_words",
    "doubled_words", "repeated_lines", "line_length", "top_word", "sentence_ends", "short_words",
)
_UPPER, _LOWER, _DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_SYMBOLS, _MARKS, _HIGH, _ENDS = b"#*$%&|<>@^~=+_\\{}[]", b"!?;:\"'()-/", bytes(range(128, 256)), b".!?"


def statistics(text: str) -> tuple[float, ...]:
    """The values of ``FEATURES`` for one whole text."""
    raw = text.encode("utf-8", "replace")
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    size = len(raw)

    def count(kind: bytes) -> int:
        return size - len(raw.translate(None, kind))

    letters = sum(map(len, words))
    upper, lower, high = count(_UPPER), count(_LOWER), count(_HIGH)
    lines = [line for line in text.split("\n") if line]
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    return (
        float(np.log1p(n)),
        letters / n,
        upper / max(1, upper + lower),
        count(_DIGITS) / size,
        count(_SYMBOLS) / size,
        count(_MARKS) / size,
        high / size,
        len(counts) / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(letters / max(1, len(lines)))),
        max(counts.values()) / n,
        count(_ENDS) / n,
        sum(len(w) < 3 for w in counts) / len(counts),
    )


def _halves(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram of gradients; place 0 for none."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - g.sum() ** 2 / (h.sum() + l2)
    gain = np.where((left_h >= least) & (right_h >= least), gain, 0.0)
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _leaf(g: np.ndarray, h: np.ndarray, l2: float) -> float:
    return float(g.sum() / (h.sum() + l2))


def _tree(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> np.ndarray:
    """A tree of depth two over one feature's bins, as a table."""
    table = np.empty(len(g))
    _, cut = _halves(g, h, l2, least)
    for low, high in ((0, cut), (cut, len(g))):
        if low == high:
            continue
        _, inner = _halves(g[low:high], h[low:high], l2, least)
        for a, b in ((low, low + inner), (low + inner, high)):
            if a < b:
                table[a:b] = _leaf(g[a:b], h[a:b], l2)
    return table


def _pair_tree(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, np.ndarray]:
    """The better of the trees that cut one axis and then each part on the other: gain, table."""
    best_gain, best = 0.0, np.full(g.shape, _leaf(g, h, l2))
    for flip in (False, True):
        own_g, own_h = (g.T, h.T) if flip else (g, h)
        table = np.empty(own_g.shape)
        gain, cut = _halves(own_g.sum(axis=1), own_h.sum(axis=1), l2, least)
        for low, high in ((0, cut), (cut, len(own_g))):
            if low == high:
                continue
            part_g, part_h = own_g[low:high], own_h[low:high]
            more, inner = _halves(part_g.sum(axis=0), part_h.sum(axis=0), l2, least)
            gain += more
            for a, b in ((0, inner), (inner, own_g.shape[1])):
                if a < b:
                    table[low:high, a:b] = _leaf(part_g[:, a:b], part_h[:, a:b], l2)
        if gain > best_gain:
            best_gain, best = gain, table.T if flip else table
    return best_gain, best


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Gam:
    """Lookup tables per feature and per pair of features."""

    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    coarse: int = 4

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.start)
        for k, table in enumerate(self.tables):
            out += table[bins[:, k]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            out += table[bins[:, i] // self.coarse, bins[:, j] // self.coarse]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.edges:
            return _logistic(np.full(len(x), self.start))
        return _logistic(self.margin(self.bins(x)))


def fit(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, most_bins: int = 64, rounds: int = 150,
    pair_rounds: int = 60, pairs: int = 6, rate: float = 0.15, l2: float = 2.0, least: float = 0.5,
) -> Gam:
    """Cyclic boosting of single-feature tables, then of pair tables, on logistic loss."""
    if not len(y):
        return Gam(0.0)
    share = (weight[y == 1].sum() + 0.5) / (weight.sum() + 1)
    model = Gam(float(np.log(share / (1 - share))))
    if y.min() == y.max():
        return model
    inner = np.linspace(0, 1, most_bins + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, k], inner)) for k in range(x.shape[1])]
    bins = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(n) for n in sizes]
    margin = model.margin(bins)
    for _ in range(rounds):
        for k, n in enumerate(sizes):
            p = _logistic(margin)
            g = np.bincount(bins[:, k], weight * (y - p), n)
            h = np.bincount(bins[:, k], weight * p * (1 - p), n)
            step = rate * _tree(g, h, l2, least)
            model.tables[k] += step
            margin += step[bins[:, k]]
    rough = bins // model.coarse
    shape = [(n - 1) // model.coarse + 1 for n in sizes]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell, p = rough[:, i] * shape[j] + rough[:, j], _logistic(margin)
        g = np.bincount(cell, weight * (y - p), shape[i] * shape[j]).reshape(shape[i], shape[j])
        h = np.bincount(cell, weight * p * (1 - p), shape[i] * shape[j]).reshape(shape[i], shape[j])
        return g, h, cell

    every = combinations(range(len(sizes)), 2)
    ranked = sorted(every, key=lambda ij: -_pair_tree(*grid(*ij)[:2], l2, least)[0])
    model.pairs = ranked[:pairs]
    model.pair_tables = [np.zeros((shape[i], shape[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h, cell = grid(i, j)
            step = rate * _pair_tree(g, h, l2, least)[1]
            table += step
            margin += step.ravel()[cell]
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = 4000, **options) -> Gam:
    """Fit on at most ``per_class`` documents of each class whose ids ``usable`` admits."""
    sample, sizes = label_sample(docs, labels, "quality", usable, per_class)

    def work():
        return lambda texts: [pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))]

    rows = map_texts(sample, work, [StructField("x", ArrayType(DoubleType()))], keys=["label"]).collect()
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    y = np.array([r["label"] for r in rows], np.float64)
    order = np.lexsort((*x.T, y))  # the same sums whatever order the rows come in
    x, y = x[order], y[order]
    return fit(x, y, class_weights(y, sizes), **options)


def score(docs: DataFrame, model: Gam) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text."""
    shared = share(docs, model)  # tables of a fixed size

    def work():
        own = shared()

        def apply(texts: list[str]) -> list[pa.Array]:
            x = np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES))
            return [pa.array(own.score(x))]

        return apply

    return map_texts(docs, work, [StructField("score", DoubleType())])


def predict(scored: DataFrame, threshold: float) -> DataFrame:
    """Adds predicted: 1 from ``threshold`` on, else 0."""
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def accepted(docs: DataFrame, model: Gam, threshold: float) -> DataFrame:
    """Rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    shared = share(docs, model)

    def work():
        own = shared()
        return lambda texts: own.score(np.array([statistics(t) for t in texts]).reshape(len(texts), -1)) >= threshold

    return filter_texts(docs, work)
