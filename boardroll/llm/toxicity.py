"""Toxicity: a counterfactually regularised classifier over words and word beginnings.

A text is the set of its distinct features: lower-cased words and, for longer words, their
beginnings, hashed. Logistic regression is fitted with two penalties: the usual one on the
size of the weights, and one on counterfactuals. Wherever a labelled text mentions an
identity term, the text is taken again with the term swapped for each other of its group, and
the squared change of its score (the logit) is penalised. Only features that the swap really
takes away or brings in count: a beginning that another word of the text holds up stays. A
group's mere mention therefore earns no weight, however often it stands beside abuse in the
labelled texts.

The model is fitted on a bounded sample of labelled documents (``per_class`` of each
class, weighted back to the true shares). Features are counted by class in Spark, and only the
``most_features`` most telling ones, and the texts' places among them, come to the driver. Toxic
texts are rare, which pulls all scores down; so the score of 0.5 is laid where the sample's
scores, each by a model fitted without it, part the classes best (by F1 of blurred scores). Every document is scored by its whole text.

Defined results: a null text is empty and has no features; without labels every score is
0.5, with labels of one class only every score is that class's smoothed share.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from boardroll.llm.common import class_weights, filter_texts, label_sample, map_texts, share, stage, unstage

# Terms that name groups neutrally; a term may be swapped for any other of its line.
IDENTITY = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("black", "white", "asian", "latino", "arab", "native"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("african", "american", "european", "mexican", "chinese", "indian", "french", "german", "spanish"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("blind", "deaf", "disabled"),
    ("femme", "homme", "musulman", "chrétien", "juif"),
    ("frau", "mann", "muslimin", "christin", "jüdin"),
    ("mujer", "hombre", "musulmán", "cristiano", "judío"),
)
_WORD = re.compile(r"[^\W\d_]+")
_BITS = 22
_KEPT_WORDS = 300_000


def features(word: str) -> tuple[int, ...]:
    """Hashed features of one lower-cased word: itself and its beginnings of 3 to 6 letters."""
    whole = (zlib.crc32(f"{word}$".encode("utf-8", "replace")) >> (32 - _BITS),)
    starts = [word[:n] for n in range(3, min(7, len(word) + 1))]
    return whole + tuple(zlib.crc32(s.encode("utf-8", "replace")) >> (32 - _BITS) for s in starts)


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass
class Model:
    """Weights of hashed features; any other feature weighs nothing."""

    bias: float
    weights: dict[int, float] = field(default_factory=dict)

    def scorer(self):
        """A function from texts to scores that remembers the telling features of words."""
        known: dict[str, tuple[int, ...]] = {}
        weights = self.weights

        def score(texts: list[str]) -> np.ndarray:
            out = np.empty(len(texts))
            for k, text in enumerate(texts):
                told: set[int] = set()
                for word in words(text):
                    own = known.get(word)
                    if own is None:
                        if len(known) >= _KEPT_WORDS:
                            known.clear()
                        own = known[word] = tuple(f for f in features(word) if f in weights)
                    if own:
                        told.update(own)
                out[k] = self.bias + sum(map(weights.__getitem__, sorted(told)))
            return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))

        return score


def _telling(sample: DataFrame, most: int, least: int = 3) -> list[int]:
    """The ``most`` features that differ most between the classes by chi-square.

    ``sample`` has label and x, the features of one text.
    """
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n = F.lit(float(sizes.get(1, 0))), F.lit(float(sum(sizes.values())))
    counted = (
        sample.select("label", F.explode("x").alias("f"))
        .groupBy("f")
        .agg(F.count(F.lit(1)).alias("total"), F.sum(F.col("label")).alias("ones"))
        .where(F.col("total") >= least)
    )
    expected = F.col("total") * n1 / n
    off = (F.col("ones") - expected) ** 2
    chi = off / expected + off / (F.col("total") - expected)
    best = counted.withColumn("chi", chi).where("chi > 4").orderBy(F.desc("chi"), "f").limit(most)
    return sorted(r["f"] for r in best.select("f").collect())


class Swaps:
    """Counterfactual texts, each as the change it makes to its text's features."""

    def __init__(self, gone: Sequence[Sequence[int]], come: Sequence[Sequence[int]], share: Sequence[float]) -> None:
        """Features (places in the model) that a swap takes away and brings in, and its weight."""
        ends = [(g, -1.0) for g in gone], [(c, 1.0) for c in come]
        self.row = np.array([k for part in ends for k, (f, _) in enumerate(part) for _ in f], np.int64)
        self.column = np.array([p for part in ends for f, _ in part for p in f], np.int64)
        self.sign = np.array([sign for part in ends for f, sign in part for _ in f])
        self.share = np.asarray(share, np.float64)

    def penalty(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean squared change of the logit, and its slope."""
        if not len(self.row):
            return 0.0, np.zeros_like(w)
        change = np.bincount(self.row, self.sign * w[self.column], len(self.share))
        slope = 2 * np.bincount(self.column, (self.sign * (self.share * change)[self.row]), len(w))
        return float(self.share @ change**2), slope


NO_SWAPS = Swaps([], [], [])


def fit(
    x: Sequence[np.ndarray], y: np.ndarray, weight: np.ndarray, size: int, swaps: Swaps = NO_SWAPS, *,
    l2: float = 1e-4, counterfactual: float = 1.0, steps: int = 400, rate: float = 0.1,
) -> tuple[float, np.ndarray]:
    """Bias and weights of logistic regression, by Adam. ``x``: each text's places among ``size`` features."""
    w = np.zeros(size)
    if not len(y):
        return 0.0, w
    share = (weight[y == 1].sum() + 0.5) / (weight.sum() + 1)
    bias = float(np.log(share / (1 - share)))
    if y.min() == y.max() or not size:
        return bias, w
    column = np.concatenate(x).astype(np.int64)
    row = np.repeat(np.arange(len(x)), [len(k) for k in x])
    first, second, first_b, second_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):
        margin = np.bincount(row, w[column], len(y)) + bias
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        error = weight * (p - y) / weight.sum()
        slope = np.bincount(column, error[row], size) + l2 * w + counterfactual * swaps.penalty(w)[1]
        slope_b = error.sum()
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        first_b, second_b = 0.9 * first_b + 0.1 * slope_b, 0.999 * second_b + 0.001 * slope_b**2
        a, b = 1 - 0.9**step, 1 - 0.999**step
        speed = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        w -= speed * (first / a) / (np.sqrt(second / b) + 1e-8)
        bias -= speed * (first_b / a) / (np.sqrt(second_b / b) + 1e-8)
    return float(bias), w


def parting(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, blur: float = 0.5) -> float:
    """The logit from which on to say 1 for the best F1.

    Scores count as blurred by about ``blur``, so that no hair's breadth between them, such as a
    penalised term leaves, can part the classes.
    """
    cuts = np.linspace(margin.min() - 1, margin.max() + 1, 400)
    said = 1 / (1 + np.exp(-np.clip((margin - cuts[:, None]) / blur, -50, 50)))
    f1 = 2 * said @ (weight * y) / (said @ weight + weight @ y)
    best = np.flatnonzero(f1 >= f1.max() * (1 - 1e-6))
    return float(cuts[best].mean())


def _calibrated(x: list[np.ndarray], y: np.ndarray, weight: np.ndarray, size: int, swaps: Swaps, folds: int, **options) -> tuple[float, np.ndarray]:
    """``fit``, with the bias moved so that 0.5 lies where held-out scores part the classes."""
    bias, w = fit(x, y, weight, size, swaps, **options)
    if not size or min((y == 0).sum(), (y == 1).sum()) < folds:
        return bias, w
    fold, margin = np.arange(len(y)) % folds, np.empty(len(y))
    options = {"steps": 150} | options  # enough to part the classes
    for k in range(folds):
        own, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        b, v = fit([x[r] for r in rest], y[rest], weight[rest], size, swaps, **options)
        margin[own] = [b + v[x[r]].sum() for r in own]
    return bias - parting(margin, y, weight), w


def _swapped(own: set[str], groups: Mapping[str, Sequence[str]]) -> list[tuple[list[int], list[int]]]:
    """For every swap of a term: features that the text loses and features that it gains."""
    held = Counter(f for w in own for f in set(features(w)))
    out = []
    for term in sorted(own & groups.keys()):
        mine = set(features(term))
        left = {f for f, n in held.items() if n > (f in mine)}
        for other in groups[term]:
            if other != term:
                new = left | set(features(other))
                out.append((sorted(held.keys() - new), sorted(new - held.keys())))
    return out


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = 3000,
    identity: Sequence[Sequence[str]] = IDENTITY, most_features: int = 6000, folds: int = 3, **options,
) -> Model:
    """Fit on at most ``per_class`` documents of each class whose ids ``usable`` admits."""
    sample, sizes = label_sample(docs, labels, "toxic", usable, per_class)
    groups = {term: group for group in identity for term in group}
    changes = pa.list_(pa.struct([("gone", pa.list_(pa.int32())), ("come", pa.list_(pa.int32()))]))

    def work():
        def apply(texts: list[str]) -> list[pa.Array]:
            told = [words(t) for t in texts]
            x = [sorted({f for w in own for f in features(w)}) for own in told]
            swaps = [[{"gone": g, "come": c} for g, c in _swapped(own, groups)] for own in told]
            return [pa.array(x, pa.list_(pa.int32())), pa.array(swaps, changes)]

        return apply

    listed = ArrayType(IntegerType())
    change = StructType([StructField("gone", listed), StructField("come", listed)])
    fields = [StructField("x", listed), StructField("swaps", ArrayType(change))]
    table = stage(map_texts(sample, work, fields, keys=["doc_id", "label"]), "toxic-features")
    chosen = _telling(table, most_features)
    shared = share(docs, np.array(chosen, np.int64))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The same rows with the places of chosen features for features."""
        known = {f: n for n, f in enumerate(shared().tolist())}
        own = lambda told: [known[f] for f in told if f in known]
        for batch in batches:
            x = [own(told) for told in batch.column(2).to_pylist()]
            swaps = [[{k: own(s[k]) for k in ("gone", "come")} for s in told] for told in batch.column(3).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.int32())), pa.array(swaps, changes)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "x", "swaps"])

    few = stage(table.mapInArrow(placed, table.schema), "telling-features")
    rows = few.orderBy(F.xxhash64("doc_id"), "doc_id").drop("doc_id").toArrow()
    y = rows.column("label").to_numpy().astype(np.float64)
    x = [told.values.to_numpy() for told in rows.column("x")]
    told = rows.column("swaps").to_pylist()
    met = [(s["gone"], s["come"], 1 / (len(y) * len(own))) for own in told for s in own]
    swaps = Swaps([m[0] for m in met], [m[1] for m in met], [m[2] for m in met])
    bias, w = _calibrated(x, y, class_weights(y, sizes), len(chosen), swaps, folds, **options)
    unstage(table, few)
    return Model(bias, dict(zip(chosen, w.tolist(), strict=True)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, the probability of being toxic) of every whole text."""
    shared = share(docs, model)  # at most most_features weights

    def work():
        apply = shared().scorer()
        return lambda texts: [pa.array(apply(texts))]

    return map_texts(docs, work, [StructField("score", DoubleType())])


def predict(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds predicted: 1 from ``threshold`` on, else 0."""
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def harmless(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = share(docs, model)

    def work():
        apply = shared().scorer()
        return lambda texts: apply(texts) < threshold

    return filter_texts(docs, work)
