import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boardroll.llm import quality_gam, queries, toxicity
from boardroll.llm.common import class_weights, label_sample, remainder

SMALL = "/root/testdata/sf0.01"


def _held_out(spark, name, label, modulus, rest):
    rows = queries.QUERIES[name](spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", label)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    out = rows.join(labels, "doc_id").collect()
    for r in out:
        assert 0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest)
    return [r for r in out if r.held_out]


def test_toxicity_held_out(spark):
    out = _held_out(spark, "op3_toxicity", "toxic", 5, 0)
    assert np.mean([r.predicted == r.toxic for r in out]) > 0.95
    assert np.mean([r.predicted for r in out if not r.toxic]) < 0.02


def test_quality_held_out(spark):
    out = _held_out(spark, "op4_quality_gam", "quality", 4, 2)
    assert np.mean([r.predicted == r.quality for r in out]) > 0.95
    assert np.mean([r.predicted for r in out if r.quality]) > 0.97


def test_toxicity_recall_on_the_larger_table(spark):
    """Nine of ten held-out toxic documents of sf0.1, and no clean one in a hundred."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(docs, labels, remainder(F.col("doc_id"), 5) != 0)
    held = docs.join(labels.select("doc_id", "toxic"), "doc_id").where(remainder(F.col("doc_id"), 5) == 0)
    scores = {r.doc_id: r.score for r in toxicity.score(held, model).collect()}
    toxic = [scores[r.doc_id] >= 0.5 for r in held.where("toxic = 1").select("doc_id").collect()]
    clean = [scores[r.doc_id] >= 0.5 for r in held.where("toxic = 0").select("doc_id").collect()]
    assert np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.01


def _labelled(spark):
    """Abuse often, and neutral mentions never, stand beside one group's name."""
    dice = random.Random(1)
    filler = [f"filler{k}" for k in range(40)]
    texts = []
    for k in range(400):
        own = dice.sample(filler, 8)
        if k % 2:
            own += ["villain"] * (dice.random() < 0.7) + ["muslims"] * (dice.random() < 0.6)
        texts.append((k, " ".join(own), k % 2))
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    return docs, spark.createDataFrame([(t[0], t[2]) for t in texts], "doc_id long, toxic int")


def test_counterfactual_penalty_at_its_default_strength(spark):
    """Fewer false positives on neutral mentions; abuse is still found, and a swap changes little."""
    docs, labels = _labelled(spark)
    neutral = [f"the {group} of the {place}" for group in ("muslims", "christians", "jews") for place in ("town", "filler3 filler9")]
    abuse = [f"such a villain of the {place}" for place in ("town", "filler3", "muslims")]
    said = {}
    for strength in (0.0, 1.0):
        model = toxicity.train(docs, labels, F.lit(True), counterfactual=strength)
        score = model.scorer()
        said[strength] = (score(neutral) >= 0.5).sum(), (score(abuse) >= 0.5).sum()
        swapped = np.ptp(score(["filler1 filler2 muslims", "filler1 filler2 jews"]))
        assert (swapped < 0.05) == (strength > 0)
    assert said[0.0][0] >= 2 and said[1.0] == (0, 3)


def test_swaps_count_only_features_that_really_change():
    groups = {"women": ("women", "men"), "men": ("women", "men")}
    ((gone, come),) = toxicity._swapped({"women", "womenfolk", "town"}, groups)
    whole = toxicity.features("women")[0]
    assert gone == [whole] and set(come) == set(toxicity.features("men"))  # beginnings are held up
    ((gone, _),) = toxicity._swapped({"women"}, groups)
    assert set(gone) == set(toxicity.features("women"))
    assert toxicity._swapped({"town"}, groups) == []


def test_parting_lies_in_the_best_gap():
    margin, y = np.array([3.0, 2.0, -4.0, -9.0, 1.0, -9.0]), np.array([1, 1, 1, 0, 1, 0])
    assert -7.5 < toxicity.parting(margin, y, np.ones(6)) < -5.5
    hair = np.array([4.0] * 5 + [0.01] * 5 + [0.0] * 90)  # no cut between nearly equal scores
    assert 1 < toxicity.parting(hair, (hair > 0).astype(int), np.ones(100)) < 3.5



def test_degenerate_labels(spark, documents):
    docs = documents((1, "good text here"), (2, None), (3, ""), (None, "x"), (4, "y " * 3000))
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for module in (quality_gam, toxicity):
        got = module.score(docs, module.train(docs, labels, F.lit(True))).collect()
        assert len(got) == 5 and {r.score for r in got} == {0.5}
    one = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    for module in (quality_gam, toxicity):
        model = module.train(docs, one, F.lit(True))
        got = module.score(docs, model).collect()
        assert {round(r.score, 6) for r in got} == {round(2.5 / 3, 6)}
        assert module.score(docs.where("false"), model).count() == 0


def test_sample_is_bounded_and_usable(spark, documents):
    docs = documents(*[(k, f"text {k}") for k in range(40)], (5, "a longer text 5"))
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    texts, sizes = label_sample(docs, labels, "quality", remainder(F.col("doc_id"), 4) != 2, 6)
    rows = texts.collect()
    assert len(rows) == 12 and len({r.doc_id for r in rows}) == 12
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in rows)
    usable = [k for k in range(40) if zlib.crc32(str(k).encode()) % 4 != 2]
    assert sizes == {0: sum(k % 2 == 0 for k in usable), 1: sum(k % 2 for k in usable)}
    assert class_weights(np.array([0, 1, 1]), {0: 30, 1: 10}) == pytest.approx([2.25, 0.375, 0.375])


def test_statistics():
    values = dict(zip(quality_gam.FEATURES, quality_gam.statistics("AB cd cd\n12 #!\n\n12 #!"), strict=True))
    assert values["upper"] == pytest.approx(2 / 6) and values["doubled_words"] == pytest.approx(1 / 7)
    assert values["repeated_lines"] == pytest.approx(1 / 3) and values["distinct_words"] == pytest.approx(4 / 7)
    assert set(quality_gam.statistics(" \n")) == {0.0}


def test_pair_tables_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality_gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y, np.ones(3000), rounds=20)
    # One cell of the pair grid (1/16 of an axis) may straddle each cut.
    assert (0, 1) in model.pairs and np.mean((model.score(x) > 0.5) == y) > 0.95


def test_toxicity_scores_against_plain_sums(documents):
    model = toxicity.Model(-0.7, {f: ((f % 13) - 6) / 10 for w in ("these", "villains", "go") for f in toxicity.features(w)})
    texts = ["These villains go", "go GO gone", "", None, "nothing told", "the these, theses!", "villains " * 5000]
    got = {r.doc_id: r.score for r in toxicity.score(documents(*enumerate(texts)), model).collect()}
    for k, text in enumerate(texts):
        told = {f for w in toxicity.words(text or "") for f in toxicity.features(w)}
        assert got[k] == pytest.approx(1 / (1 + math.exp(-model.bias - sum(model.weights.get(f, 0.0) for f in told))))


def test_quality_scores_against_table_lookups(documents):
    """Every score is the start plus one cell of each feature's and of each pair's table."""
    rng = np.random.default_rng(2)
    width = len(quality_gam.FEATURES)
    x = rng.normal(size=(300, width))
    model = quality_gam.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float), np.ones(300), rounds=10, pair_rounds=10)
    texts = ["A plain text, of two lines.\nHere it ends.", "", None, "x " * 3000, "!!! ???"]
    got = {r.doc_id: r.score for r in quality_gam.score(documents(*enumerate(texts)), model).collect()}
    for k, text in enumerate(texts):
        own = quality_gam.statistics(text or "")
        bins = [sum(edge <= value for edge in edges) for edges, value in zip(model.edges, own, strict=True)]
        total = model.start + sum(t[b] for t, b in zip(model.tables, bins, strict=True))
        total += sum(t[bins[i] // model.coarse][bins[j] // model.coarse] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        assert got[k] == pytest.approx(1 / (1 + math.exp(-total)))
