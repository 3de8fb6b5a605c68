import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from boardroll.llm import lexical_search, queries
from boardroll.llm.common import small_batches, stage
from boardroll.llm.lexical_search import Treap, build_index, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def slow_search(docs, items, k):
    """(item, rank, doc, score) by scoring every document for every item."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, bag in bags:
            m = 10 + (90 * bag.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in wanted
                if t in bag
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def invented(seed, n):
    draw = random.Random(seed)
    word = lambda: f"w{int(draw.expovariate(0.05))}"
    return " ".join(word() for _ in range(n))


def test_terms_are_runs_of_term_characters():
    for text in ("A-Z é x, it's 3rd\tÀ_b", "\x00", "", "ABC\u0085d [x] {y}~"):
        assert [t.decode() for t in lexical_search.terms_of(text)] == terms(text)


def test_treap_holds_every_entry():
    rng = np.random.default_rng(3)
    cells = np.unique(rng.integers(0, 40 * 300, 900))
    rows_, columns = cells // 300, cells % 300
    tf, impact = rng.integers(1, 9, len(cells)), rng.integers(1, 1_000_000, len(cells))
    treap = Treap.build(rows_, columns, tf, impact)
    found, level = [(0, 0, 0)], 0
    for level, quarters in enumerate(treap.quarters):
        below, first = [], treap.children(level)
        for row, column, cell in found:
            inside = [k for k in range(4) if quarters[cell] >> k & 1]
            size = 1 << (len(treap.quarters) - level)
            mine = (rows_ // size == row) & (columns // size == column)
            assert impact[mine].max() <= 16 * int(treap.maxima[level][cell]) < impact[mine].max() + 16
            below += [(2 * row + k // 2, 2 * column + k % 2, int(first[cell]) + n) for n, k in enumerate(inside)]
        found = below
    assert {(r, c, int(treap.occurrences[cell])) for r, c, cell in found} == set(zip(rows_, columns, tf, strict=True))


@pytest.mark.parametrize("segment_docs,segment_cells,block", [(4096, 500_000, 512), (7, 500_000, 2), (4096, 60, 1)])
def test_search_against_brute_force(spark, documents, segment_docs, segment_cells, block):
    texts = [(k, invented(k, 1 + k * 7 % 60)) for k in range(150)]
    texts += [(900 + k, texts[5][1]) for k in range(25)]  # ties over many copies
    texts += [(2000, None), (2001, ""), (2002, "!!"), (None, texts[8][1]), (3, texts[3][1])]
    items = [(k, invented(1000 + k, 9)) for k in range(12)] + [(50, texts[5][1]), (51, None), (52, "unheard"), (0, "W1 w2")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    index = build_index(documents(*texts), segment_docs, segment_cells)
    assert rows(search(index, asked, 10, block)) == slow_search(texts, items, 10)


def test_small_batches_of_nodes_change_nothing(documents):
    texts = [(k, invented(k, 30)) for k in range(120)]
    index = build_index(documents(*texts, parts=1))
    row = index.segments.drop("counts").toArrow()
    segment = lexical_search._Segment({name: row.column(name)[0] for name in row.column_names})
    wanted = np.arange(len(segment.terms))[::3]
    results = []
    for entries in (1, 64, 1 << 20):
        best = lexical_search.Best(7)
        lexical_search.descend(segment, wanted, np.arange(1, len(wanted) + 1), best, entries)
        results.append((best.scores.tolist(), best.ids.tolist()))
    assert results[0] == results[1] == results[2]


def test_empty_tables(spark, documents):
    asked = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for docs, items in ((documents((1, "a")).limit(0), asked), (documents((1, "a")), asked.limit(0)), (documents((1, None)), asked)):
        found = search(build_index(docs), items)
        assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_query_equals_its_twin(spark):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    twin = duck.execute(f"SELECT item_id, rank, doc_id, score FROM ({queries.ORACLES['op11_lexical_search']})").fetchall()
    assert rows(queries.QUERIES["op11_lexical_search"](spark, "/root/testdata/sf0.001")) == sorted(twin, key=str)


def test_segments_are_stored_a_few_at_a_time(spark, documents):
    docs = [(i, invented(i, 30)) for i in range(60)]
    index = build_index(documents(*docs, parts=1), segment_docs=1)
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.segments.inputFiles()]
    groups = [m.row_group(g).num_rows for m in files for g in range(m.num_row_groups)]
    assert sum(groups) == 60
    assert max(groups) <= 8


def test_batches_to_python_are_small_and_the_session_is_left_as_it_was(spark):
    texts = spark.range(3000, numPartitions=1).selectExpr("repeat('x', 10000) AS text")
    asked = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(k) for k in asked]

    def sizes(batches):
        yield pa.RecordBatch.from_arrays([pa.array([b.nbytes for b in batches], pa.int64())], names=["n"])

    with small_batches(spark):
        held = [r["n"] for r in texts.mapInArrow(sizes, "n long").collect()]
    assert sum(held) >= 3000 * 10000
    assert max(held) < 8 << 20
    assert [spark.conf.get(k) for k in asked] == before
    with pytest.raises(KeyError), small_batches(spark):
        raise KeyError
    assert [spark.conf.get(k) for k in asked] == before


def test_index_and_search_run_in_small_batches(spark, documents, monkeypatch):
    seen = []

    def noted(df, name, **layout):
        seen.append((name, spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")))
        return stage(df, name, **layout)

    monkeypatch.setattr(lexical_search, "stage", noted)
    found = search(build_index(documents((1, "a b"), (2, "b c"))), spark.createDataFrame([(7, "c")], "item_id long, text string"))
    assert [r[2] for r in rows(found)] == [2]
    assert {name for name, _ in seen} == {"treaps", "item-terms", "weighted-terms", "found"}
    assert {size for _, size in seen} == {"4m"}
