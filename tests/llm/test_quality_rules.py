import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from boardroll.llm import quality_rules as rules

BLANK = "[\x20\x09-\x0d]+"


def slow(text):
    words = [w for w in re.split(BLANK, text or "") if w]
    runs = {}
    for k in range(len(words) - 7):
        runs.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {k + d for places in runs.values() if len(places) > 1 for k in places for d in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


def _texts():
    dice = random.Random(2)
    words = [f"w{k}" for k in range(30)] + ["é#", "a|b", "日本"]
    long = " ".join(dice.choice(words) for _ in range(30000))
    part = " ".join(words[:11])
    return [
        None, "", " \t\n\x0b\x0c\r ", "one", "a\nb\na\n \n \nb", " lead and trail ", "x " * 40, part, f"{part} {part}",
        f"{part} y {part}\n{part}\r\n", "a b c d e f g h " * 2 + "i", long, long + " " + long, "<<>>##" * 50,
    ]


def test_statistics_against_brute_force(documents):
    texts = _texts() * 2
    out = rules.judge(documents(*enumerate(texts))).collect()
    assert len(out) == len(texts)
    for r in out:
        want = slow(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.kept and r.base_failed)


def _prose(dice, n):
    return " ".join("".join(dice.choice("abcdefgh") for _ in range(dice.randint(2, 9))) for _ in range(n))


def test_outliers_are_rejected_per_group(spark):
    dice = random.Random(6)
    rows = [(k, _prose(dice, dice.randint(80, 400)), "en", "big" if k % 3 else None) for k in range(600)]
    odd = [(1000 + k, " ".join(w + "#$%&" * 9 for w in _prose(dice, 200).split()), "en", "big") for k in range(30)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string").repartition(4)
    out = rules.judge(docs).collect()
    assert all(r.kept for r in out if r.doc_id < 1000)
    assert not any(r.kept or r.base_failed for r in out if r.doc_id >= 1000)


def test_few_rows_have_no_outliers_and_empty_table(documents):
    docs = documents((1, "<#> " * 5 + " ".join(map(str, range(40)))), (None, None))
    out = {r.doc_id: r for r in rules.judge(docs).collect()}
    assert out[1].kept and not out[None].kept and out[None].base_failed
    assert rules.judge(docs.where("false")).count() == 0


def test_estimate_is_robust(spark):
    """A fifth of gross outliers moves neither the location nor the scatter by much."""
    rng = np.random.default_rng(1)
    mix = np.array([[1, 0, 0, 0], [0.8, 0.6, 0, 0], [0, 0, 2, 0], [0.3, 0, 0, 1]])
    good = rng.normal(size=(4000, 4)) @ mix.T + [1, 2, 3, 4]
    bad = rng.normal(size=(1000, 4)) * 0.1 + [30, -30, 30, -30]
    rows = [("g", *map(float, r)) for r in np.concatenate([good, bad])]
    vectors = spark.createDataFrame(rows, "grp string, x0 double, x1 double, x2 double, x3 double").repartition(4)
    vectors = vectors.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(rules.SALTS)).cast("int"))
    (r,) = rules.estimate(vectors).collect()
    assert [r.m0, r.m1, r.m2, r.m3] == pytest.approx([1, 2, 3, 4], abs=0.15)
    low = np.array([[r[f"l{j}{i}"] if i <= j else 0.0 for i in range(4)] for j in range(4)])
    true = mix @ mix.T
    # The core is 94 % of the good rows; cutting off the rest shrinks the scatter somewhat.
    shape = low @ low.T - np.diag(np.square(rules.FLOORS))
    assert np.all(np.diag(shape) > 0.7 * np.diag(true)) and np.all(np.diag(shape) < 1.1 * np.diag(true))
    assert np.abs(shape - true).max() < 0.6


def test_plan_is_native(documents):
    frame = rules.judge(documents(*[(k, f"text {k} with some words") for k in range(60)]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    assert frame.where(F.col("distance").isNull()).count() == 0


def test_a_third_of_copies_or_mixed_bad_texts(spark):
    dice = random.Random(8)
    bad = [" ".join(w + "#$%&" * 9 for w in _prose(dice, dice.randint(80, 400)).split()) for _ in range(300)]
    rows = [(k, _prose(dice, dice.randint(80, 400)), "en", s) for s in ("copies", "mixed") for k in range(600)]
    rows += [(1000 + k, bad[0], "en", "copies") for k in range(300)] + [(1000 + k, t, "en", "mixed") for k, t in enumerate(bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    out = rules.judge(docs).collect()
    assert all(r.kept for r in out if r.doc_id < 1000)
    assert not any(r.kept or r.base_failed for r in out if r.doc_id >= 1000)


def test_rare_sources_are_judged_by_language_and_table(spark):
    dice = random.Random(9)
    bad = [" ".join(w + "#$%&" * 9 for w in _prose(dice, 200).split()) for _ in range(4)]
    rows = [(k, _prose(dice, dice.randint(80, 400)), "en", "hot") for k in range(300)]
    rows += [(400 + k, _prose(dice, 200), "en", f"rare{k % 3}") for k in range(12)]
    rows += [(500 + k, _prose(dice, 200), None, "other") for k in range(5)]
    places = [("en", "rare0"), ("en", "new"), (None, "other"), ("xx", None)]
    rows += [(1000 + k, text, *place) for k, (text, place) in enumerate(zip(bad, places, strict=True))]
    few = [(k, _prose(dice, dice.randint(80, 400)), "en", "s") for k in range(30)] + [(1000, bad[0], "en", "s")]
    for table in (rows, few):
        docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string").repartition(4)
        out = rules.judge(docs).collect()
        assert len(out) == len(table)
        assert all(r.kept for r in out if r.doc_id < 1000)
        assert not any(r.kept or r.base_failed for r in out if r.doc_id >= 1000)
