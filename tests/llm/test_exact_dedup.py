import hashlib

from pyspark.sql import functions as F

from boardroll.llm import exact_dedup


def slow(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(t or "", []).append((i is not None, i or 0, k))
    return groups


ROWS = [
    (1, "one text"), (2, "two text"), (3, "one text"), (9, None), (8, ""), (5, "long " * 4000 + "a"),
    (6, "long " * 4000 + "b"), (7, "long " * 4000 + "a"), (10, "same length"), (11, "length same"),
    (12, "One text"), (13, "x"), (13, "x"), (13, "x"), (4, "x"), (None, "nobody"), (None, "nobody"),
    (None, "one text"), (20, "alone"), (21, "é" * 50), (22, "é" * 50),
]


def test_against_brute_force(documents):
    for bits in (1 << 26, 1 << 15):
        out = exact_dedup.exact_duplicates(documents(*ROWS), prefix=5, most_bits=bits, digests=True).collect()
        groups = slow(ROWS)
        want = []
        for text, members in groups.items():
            keep = max(members)[1] if max(members)[0] else None
            sha = hashlib.sha256(text.encode()).hexdigest()
            want += [(i if known else None, keep, len(members), sha) for known, i, _ in members]
        got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out]
        assert sorted(got, key=str) == sorted(want, key=str)
        stay = [r for r in out if r.kept]
        assert len(stay) == len(groups) == len({r.text_sha256 for r in stay})
        assert all(r.doc_id == r.keep_id for r in stay)


def test_rows_that_stay(documents):
    docs = documents(*ROWS)
    out = exact_dedup.without_exact_duplicates(docs)
    assert out.columns == docs.columns
    got = sorted((r.text or "", r.doc_id) for r in out.collect() if r.doc_id is not None)
    want = sorted((t, max(m)[1]) for t, m in slow(ROWS).items() if max(m)[0])
    assert got == want and out.where(F.col("doc_id").isNull()).count() == 1


def test_empty_table(documents):
    docs = documents((1, "a")).where("false")
    assert exact_dedup.exact_duplicates(docs).count() == 0
    assert exact_dedup.without_exact_duplicates(docs).count() == 0


def test_plan_is_native(documents):
    frame = exact_dedup.exact_duplicates(documents(*ROWS))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
