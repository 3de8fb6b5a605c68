import collections

import pytest
from pyspark.sql import functions as F
from llm.test_packing import check
from llm.test_simhash import slow_components, slow_fingerprint

import corpus_pipeline
from boardroll.llm import packing, quality_gam, simhash, toxicity
from boardroll.llm.common import keep_marked, remainder, stage, text_digest

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], SMALL), name))
    return out


def _texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns_and_order(results):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and names[0] == "quality_classifier" and names[-1] == "best_fit_packing"
    for frame in results[1:5]:
        assert frame.columns == results[0].columns and frame.schema == results[0].schema


def test_classifier_stages_follow_their_scores(spark, results):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs, good, safe = results[:3]
    model = quality_gam.train(docs, labels, remainder(F.col("doc_id"), 4) != 2)
    want = {r.doc_id for r in quality_gam.score(docs, model).collect() if r.score >= 0.7}
    assert set(_texts(good)) == want
    model = toxicity.train(good, labels, remainder(F.col("doc_id"), 5) != 0)
    want = {r.doc_id for r in toxicity.score(good, model).collect() if r.score < 0.5}
    assert set(_texts(safe)) == want


def test_dedup_stages_against_brute_force(results):
    safe, single, distinct = (_texts(frame) for frame in results[2:5])
    last = {}
    for doc, text in safe.items():
        last[text] = max(doc, last.get(text, doc))
    assert single == {doc: text for text, doc in last.items()}
    ids = sorted(single)
    roots = slow_components([slow_fingerprint(single[k]) for k in ids])
    assert distinct == {k: single[k] for n, k in enumerate(ids) if roots[n] == n}


def test_packing_holds_all(results):
    lengths = {k: len((t or "").split()) + 1 for k, t in _texts(results[4]).items()}
    check(results[5].collect(), lengths, packing.COSTS)


def test_run_gives_the_last_stage(spark, results):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == results[5].columns and out.count() == results[5].count()


def test_near_copies_with_repeated_and_null_ids(documents):
    base = " ".join(f"w{k}" for k in range(300))
    rows = [(5, base), (5, base), (3, base + " x"), (5, "something else entirely here"), (None, base), (None, None), (None, None)]
    got = [(r.doc_id, r.text) for r in simhash.without_near_duplicates(documents(*rows)).collect()]
    assert collections.Counter(got) == collections.Counter([rows[2], rows[3], (None, None)])


def test_full_bitmap_changes_nothing(documents):
    docs = documents(*[(k, f"text {k}") for k in range(3000)])
    marked = docs.select("doc_id", text_digest(docs).alias("digest"), (F.col("doc_id") % 2 == 0).alias("kept"))
    for bits in (1 << 15, 1 << 26):
        kept = keep_marked(docs, marked, bits)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(0, 3000, 2))


def test_empty_documents(spark, documents, tmp_path):
    docs = documents((1, "x")).where("false")
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL), "empty")
    assert docs.count() == 0
