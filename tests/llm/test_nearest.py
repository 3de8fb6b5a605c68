import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boardroll.llm import nearest as nn
from boardroll.llm import queries

SMALL = nn.Shape(degree=10, sample=6, trees=2, leaf=40, rounds=4)


def slow(rows, wanted, k):
    """(query, rank, id, distance) by measuring every pair; of an id's vectors the smaller counts."""
    sound = {}
    for i, vector in rows:
        if i is None or vector is None or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        sound[i] = min(sound.get(i, vector), vector)
    ids = sorted(sound)
    places = np.array([sound[i] for i in ids], np.float64)
    out = []
    for i in filter(wanted, ids):
        d = np.sqrt(((places - np.array(sound[i])) ** 2).sum(axis=1))
        best = [n for n in np.lexsort((ids, d)) if ids[n] != i][:k]
        out += [(i, r + 1, ids[n], round(float(d[n]), 9)) for r, n in enumerate(best)]
    return out


@pytest.fixture
def vectors(spark):
    def build(rows, parts=3):
        ddl = "vec_id long, embedding array<float>, label int, node long, d double"
        full = [(i, v, 1, 5, 0.5) for i, v in rows]
        return spark.createDataFrame(full, ddl).repartition(parts)

    return build


def found(frame, wanted, k, shape=SMALL, **more):
    graph = nn.build_graph(frame, k, shape)
    got = nn.nearest(graph, frame, wanted, k, **more).collect()
    return sorted((q, r, v, round(s, 9)) for q, r, v, s in got)


def plain(array):
    return [float(np.float32(x)) for x in array]


def test_codes_keep_the_places():
    rng = np.random.default_rng(1)
    places = rng.normal(size=(50, 9)) * np.exp(rng.normal(size=(50, 1)) * 20)
    codes = pa.array([c.tobytes() for c in nn.encode(places)], pa.binary())
    back = nn.decode(nn._bytes(codes.slice(10, 20)))
    assert np.abs(back - places[10:30]).max(axis=1).max() <= np.abs(places).max()
    assert (np.abs(back - places[10:30]) <= np.abs(places[10:30]).max(axis=1)[:, None] / 250).all()
    assert not nn.decode(nn.encode(np.zeros((1, 3)))).any()


def test_pairs_keep_the_nearest_of_each():
    v, u, d = np.array([1, 1, 1, 2, 1]), np.array([7, 8, 7, 9, 6]), np.array([0.5, 0.1, 0.4, 1.0, 0.9])
    kept = nn._pairs(v, u, d, 2).to_pylist()
    assert [tuple(r.values()) for r in kept] == [(1, 8, 0.1), (1, 7, 0.4), (2, 9, 1.0)]
    assert nn._pairs(v[:0], u[:0], d[:0], 2).num_rows == 0


def test_recall_and_scores(vectors):
    """Random vectors, the hardest kind, with far more than one group a deal."""
    rng = np.random.default_rng(5)
    rows = [(int(k), plain(x)) for k, x in enumerate(rng.normal(size=(400, 12)))]
    frame = vectors(rows)
    got = found(frame, F.col("vec_id") % 20 == 0, 10, pool=80, opened=20)
    exact = slow(rows, lambda i: i % 20 == 0, 10)
    assert len(got) == len(exact)
    assert len({g[::2] for g in got} & {e[::2] for e in exact}) >= 0.95 * len(exact)
    places = {i: np.array(v) for i, v in rows}
    assert all(abs(np.linalg.norm(places[q] - places[v]) - s) < 1e-8 for q, _, v, s in got)


def test_copies_ties_and_rows_that_take_no_part(vectors):
    """A third of the rows are one vector; ties go to the smaller id."""
    rng = np.random.default_rng(6)
    centre = plain(rng.normal(size=4))
    rows = [(k, centre) for k in range(100, 160)]
    rows += [(k, plain(np.array(centre) + 1e-2 * rng.normal(size=4))) for k in range(60)]
    rows += [(k, plain(5 * rng.normal(size=4) + 40)) for k in range(200, 260)]
    rows += [(300, None), (301, [0.0] * 4), (302, [1.0, None, 1.0, 1.0]), (303, [1.0, float("nan"), 1.0, 1.0])]
    rows += [(304, [float("inf"), 1.0, 1.0, 1.0]), (None, centre), (5, rows[65][1]), (6, [9.0] * 4)]
    got = found(vectors([*rows, (305, [1.0])]), F.col("vec_id") % 10 == 0, 10)
    assert got == slow(rows, lambda i: i % 10 == 0, 10)


@pytest.mark.parametrize("n", [1, 5])
def test_few_rows_give_all_candidates(vectors, n):
    rows = [(k, [float(k), 1.0]) for k in range(n)]
    assert found(vectors(rows), F.col("vec_id") >= 0, 10) == slow(rows, lambda i: True, 10)


def test_no_queries_and_empty_table(vectors):
    frame = vectors([(1, [1.0, 2.0]), (2, [1.0, 3.0])])
    assert found(frame, F.col("vec_id") > 9, 10) == []
    empty = nn.nearest(nn.build_graph(frame.limit(0)), frame.limit(0), F.lit(True))
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]


def test_query_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    exact = {e[::2] for e in slow(rows, lambda i: i % 100 == 0, 10)}
    got = [(r["query_id"], r["vec_id"]) for r in queries.QUERIES["op12_nearest"](spark, folder).collect()]
    assert len(got) == len(set(got)) == len(exact) and len(exact & set(got)) >= 0.95 * len(exact)
