from datetime import date, timedelta
from random import Random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from boardroll import operators as op
from boardroll.operators.scan import Cuts


def test_latest_takes_one_row_per_key_and_limits_before_the_shuffle(frame):
    df = frame("k string, d date, v int", ("a", "2020-01-01", 1), ("a", "2020-02-01", 2), ("b", "2020-01-01", 3))
    got = op.latest(df, ["k"], F.col("d").desc())
    assert rows(got, "k", "v") == [("a", 2), ("b", 3)]
    assert "WindowGroupLimit" in got._jdf.queryExecution().toString()


def test_island_ids_share_positions_and_break_on_gaps(frame):
    df = frame("k int, p int", (1, 3), (1, 4), (1, 4), (1, 6), (1, 7), (2, 1))
    assert rows(op.island_ids(df, ["k"], "p")) == [(1, 3, 0), (1, 4, 0), (1, 4, 0), (1, 6, 1), (1, 7, 1), (2, 1, 0)]
    assert op.island_ids(df.limit(0), ["k"], "p").count() == 0


def test_merge_intervals(frame):
    df = frame(
        "k string, s date, e date",
        ("a", "2021-03-01", "2021-03-05"),  # Friday
        ("a", "2021-03-08", "2021-03-10"),  # Monday: same island
        ("a", "2021-03-12", "2021-03-15"),  # two weekdays later: new island
        ("a", "2021-03-12", "2021-03-31"),  # same start: the longest counts
        ("b", "2021-03-01", None),
    )
    assert rows(op.merge_intervals(df, ["k"], "s", "e")) == [
        ("a", 1, "2021-03-01", "2021-03-10"),
        ("a", 2, "2021-03-12", "2021-03-31"),
        ("b", 1, "2021-03-01", None),
    ]


def test_headcount_cases(frame):
    df = frame(
        "k string, s date, e date, m int, lo date",
        ("a", "2021-09-01", "2022-06-30", 1, "2021-08-31"),
        ("a", "2021-09-01", "2022-06-30", 2, "2021-08-30"),
        ("a", "2021-10-01", "2021-12-01", 3, "2021-08-29"),  # late arrival, early leaver
        ("a", "2021-11-01", "2021-11-01", 4, "2021-08-28"),  # in and out on one day
        ("a", "2021-09-01", "2022-06-30", 1, "2021-08-27"),  # repeated member counts once
    )
    got = op.headcount(df, ["k"], "s", "e", "m", "day", "n", lowest=["lo"])
    assert rows(got, "day", "n", "lo") == [
        ("2021-09-01", 2, "2021-08-27"),
        ("2021-10-01", 3, "2021-08-29"),
        ("2021-11-01", 3, "2021-08-28"),
        ("2021-12-01", 2, "2021-08-29"),
        ("2022-06-30", 0, "2021-08-27"),
    ]


def _random_rows(seed, n=300):
    random = Random(seed)
    start = date(2020, 1, 1)
    return [
        (random.choice("aaab"), (start + timedelta(random.randrange(200))).isoformat(), i,
         random.choice([None, *range(9)]))
        for i in range(n)
    ]


def _by_key(data):
    keys = {}
    for row in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        keys.setdefault(row[0], []).append(row)
    return keys.values()


@pytest.mark.parametrize("seed", [1, 2])
def test_scans_equal_a_plain_loop_on_a_hot_key(frame, seed):
    data = _random_rows(seed)
    df = frame("k string, d date, i int, v int", *data)
    order, cut = ["d", "i"], {"chunk_rows": 20}
    total = op.running_sum(df, ["k"], order, F.coalesce("v", F.lit(0)), "x", **cut)
    before = op.running_sum(df, ["k"], order, F.lit(1), "x", include_current=False, **cut)
    previous = op.previous_value(df, ["k"], order, F.col("v"), "x", **cut)
    filled = op.carry_forward(df, ["k"], order, "v", "x", **cut)
    whole = op.carry_forward(df, ["k"], order, "v", "x", chunk_rows=None)
    expect = {"total": {}, "before": {}, "previous": {}, "filled": {}}
    for group in _by_key(data):
        running, last, prior = 0, None, None
        for n, (_, _, i, v) in enumerate(group):
            expect["before"][i] = n or None
            expect["previous"][i] = prior
            running, prior = running + (v or 0), v
            last = v if v is not None else last
            expect["total"][i], expect["filled"][i] = running, last
    for name, df_ in [("total", total), ("before", before), ("previous", previous), ("filled", filled), ("filled", whole)]:
        assert {r.i: r.x for r in df_.select("i", "x").collect()} == expect[name], name
        assert sorted(df_.columns) == ["d", "i", "k", "v", "x"]


@pytest.mark.parametrize("seed", [3, 4])
def test_range_joins_equal_brute_force(frame, seed):
    random, start = Random(seed), date(2019, 11, 1)

    def day(n):
        return (start + timedelta(n)).isoformat()

    points = [(random.choice("ab"), day(random.randrange(500)), i) for i in range(60)]
    points.append(("a", None, 60))
    spans = []
    for i in range(60):
        first = random.randrange(500)
        spans.append((random.choice("abc"), day(first), day(first + random.randrange(-3, 200)), i))
    spans.append(("a", "2020-01-01", "9999-12-31", 60))
    p = frame("k string, at date, i int", *points)
    s = frame("k string, first date, last date, j int", *spans)
    for buckets in (op.Buckets(days=30), op.Buckets(days=100, last=date(2020, 3, 1))):
        inner = op.point_in_interval_join(p, s, ["k"], "at", "first", "last", buckets=buckets)
        expected = {(i, j) for k, at, i in points for k2, a, b, j in spans if k == k2 and at and a <= at <= b}
        got = inner.select("i", "j").collect()
        assert len(got) == len(expected) and {tuple(r) for r in got} == expected
        left = op.point_in_interval_join(p, s, ["k"], "at", "first", "last", "left", buckets)
        assert {r.i for r in left.filter("j IS NULL").collect()} == {i for *_, i in points} - {i for i, _ in expected}
        other = s.withColumnsRenamed({"first": "f2", "last": "l2", "j": "j2"})
        pairs = op.overlap_join(s, other, ["k"], ("first", "last"), ("f2", "l2"))
        expected = {
            (j, j2) for k, a, b, j in spans for k2, a2, b2, j2 in spans
            if k == k2 and a <= b and a2 <= b2 and a <= b2 and a2 <= b
        }
        got = pairs.select("j", "j2").collect()
        assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def _disjoint(random, keys):
    spans, number = [], 0
    for k in keys:
        at = 0
        for _ in range(25):
            first = at + random.randrange(4)
            at = first + random.randrange(1, 20)
            spans.append((k, first, at - 1 - random.randrange(2), number))  # some without days
            number += 1
    return spans


@pytest.mark.parametrize("chunk_rows", [None, 9])
def test_as_of_join_equals_brute_force(frame, chunk_rows):
    random, start = Random(9), date(2019, 11, 1)
    day = lambda n: (start + timedelta(n)).isoformat()
    spans = [*_disjoint(random, "abc"), ("d", 5, 2_900_000, 900)]
    points = [(random.choice("aaabdz"), random.randrange(-5, 300), i) for i in range(400)]
    p = frame("k string, at date, i int", *[(k, day(n), i) for k, n, i in points], ("a", None, 400), (None, day(5), 401))
    s = frame("k string, first date, last date, j int, at int", *[(k, day(a), day(b), j, j) for k, a, b, j in spans])
    expected = {i: j for k, n, i in points for k2, a, b, j in spans if k == k2 and a <= n <= b}
    inner = op.as_of_join(p, s.drop("at"), ["k"], "at", "first", "last", chunk_rows=chunk_rows)
    assert inner.columns == ["k", "at", "i", "j"]
    got = inner.select("i", "j").collect()
    assert len(got) == len(expected) and dict(map(tuple, got)) == expected
    left = op.as_of_join(p, s.drop("at"), ["k"], "at", "first", "last", "left", chunk_rows)
    assert {r.i: r.j for r in left.collect()} == {i: expected.get(i) for i in range(402)}
    plan = inner._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    empty = op.as_of_join(p, s.drop("at").limit(0), ["k"], "at", "first", "last", "left", chunk_rows)
    assert empty.count() == 402 and empty.where("j IS NOT NULL").isEmpty()
    with pytest.raises(ValueError):
        op.as_of_join(p, s, ["k"], "at", "first", "last", "full")


def test_clashing_intervals(frame):
    df = frame("k string, a int, b int", ("x", 1, 9), ("x", 2, 3), ("x", 9, 9), ("x", 10, 12), ("y", 2, 4), ("x", 5, 4), (None, 1, 2))
    days = df.selectExpr("k", "date_add(DATE '2020-01-01', a) AS a", "date_add(DATE '2020-01-01', b) AS b", "a AS n")
    assert rows(op.clashing_intervals(days, ["k"], "a", "b"), "k", "n") == [("x", 2), ("x", 9)]


def test_overlap_join_copies_no_span_more_than_nine_times(spark, frame):
    """Spans without an end, alone and in numbers, beside short ones."""
    random, start = Random(4), date(1995, 1, 1)
    spans = []
    for i in range(150):
        first = random.randrange(9000)
        length = random.choice([0, 1, 31, 32, 33, 400, 5000])
        spans.append((random.choice("ab"), start + timedelta(first), start + timedelta(first + length), i))
    spans += [("a", date(1960, 5, 1), date(2100, 1, 1), 150), ("a", date(1, 1, 1), date(9999, 12, 31), 151), ("b", date(2001, 1, 1), date(9999, 12, 31), 152)]
    text = [(k, a.isoformat(), b.isoformat(), i) for k, a, b, i in spans]
    one = frame("k string, a date, b date, i int", *text)
    two = frame("k string, c date, d date, j int", *text, ("a", None, "2020-01-01", 900), ("a", "2020-01-01", None, 901))
    pairs = op.overlap_join(one, two, ["k"], ("a", "b"), ("c", "d"))
    expected = {(i, j) for k, a, b, i in spans for k2, c, d, j in spans if k == k2 and a <= d and c <= b}
    got = pairs.select("i", "j").collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected
    from boardroll.operators.intervals import _cells_of_day, _cells_of_span

    cells = one.select(F.size(_cells_of_span(F.col("a"), F.col("b"))).alias("n"), F.size(_cells_of_day(F.col("a"))).alias("m"))
    assert cells.agg(F.max("n"), F.max("m")).first()[:] == (2, 7)


def test_expand_years(frame):
    df = frame("i int, a date, b date", (1, "2019-06-30", "2020-07-01"), (2, "2020-07-01", None), (3, "2021-01-01", "2020-01-01"))
    assert rows(op.expand_years(df, "a", "b"), "i", "school_year") == [(1, 2018), (1, 2019), (1, 2020)]


def test_changes_to_intervals(frame):
    log = frame(
        "k string, at date, v string, w timestamp",
        ("x", "2020-01-01", "A", "2020-01-01 08:00:00"),
        ("x", "2020-02-01", "A", "2020-02-01 08:00:00"),  # no change
        ("x", "2020-03-01", "B", "2020-03-01 08:00:00"),
        ("x", "2020-03-01", "C", "2020-03-01 09:00:00"),  # the day's last value holds
        ("x", "2020-04-01", "D", "2020-04-01 08:00:00"),
        ("x", "2020-04-01", "C", "2020-04-01 09:00:00"),  # moved away and back: still a change
    )
    got = op.changes_to_intervals(log, "k", "at", "v", "w", F.lit(date(2020, 12, 31)))
    assert rows(got, "v", "valid_from", "valid_until") == [
        ("A", "2020-01-01", "2020-03-01"),
        ("C", "2020-03-01", "2020-04-01"),
        ("C", "2020-04-01", "2020-12-31"),
    ]


def test_clip_interval_ignores_null_bounds(frame):
    df = frame("a date, b date, lo date, hi date", ("2020-01-01", "2020-12-31", "2020-02-01", None))
    start, end = op.clip_interval(*[F.col(c) for c in ("a", "b", "lo", "hi")])
    assert rows(df.select(start, end)) == [("2020-02-01", "2020-12-31")]


def test_labelled_cube_totals_equal_the_sum_of_cells(frame):
    df = frame("y int, a string, b string, v int", (1, "x", "p", 1), (1, "x", "q", 2), (1, "z", "p", 4), (1, None, "p", 8), (2, "x", "p", 16))
    cube = op.labelled_cube(df, ["y"], {"a": "All", "b": "Any"}, {"v": F.sum("v")})
    got = rows(cube)
    assert (1, "All", "Any", 15) in got and (2, "All", "Any", 16) in got
    assert [r for r in got if r[:3] == (1, "All", "p")] == [(1, "All", "p", 13)]
    assert [r for r in got if r[:3] == (1, op.UNKNOWN, "p")] == [(1, op.UNKNOWN, "p", 8)]
    unlabelled = op.labelled_cube(df, ["y"], {"a": None, "b": "Any"}, {"v": F.sum("v")})
    assert (1, None, "Any", 15) in rows(unlabelled)


def test_row_cube(frame):
    got = rows(op.row_cube(frame("a string, b string", ("x", "y")), ["a", "b"], "All"))
    assert got == [("All", "All"), ("All", "y"), ("x", "All"), ("x", "y")]


def test_resolve_flag_rules_in_order(frame):
    df = frame(
        "g string, ref string, known int, preferred int",
        ("log", "1", 1, 0), ("log", "2", 0, 1),
        ("only", "1", None, None),
        ("pref", "1", 0, 1), ("pref", "2", 0, 0),
        ("last", "1", None, None), ("last", "2", None, None),
    )
    got = op.resolve_flag(df, ["g"], "ref", F.col("known"), F.col("preferred"))
    assert rows(got.filter("is_main = 1"), "g", "ref") == [("last", "2"), ("log", "1"), ("only", "1"), ("pref", "1")]


def test_allocate_rules_and_total(frame):
    df = frame(
        "l int, q double, part double, total double, keep boolean",
        (1, 10.0, 30.0, 100.0, False), (1, 10.0, 70.0, 100.0, False),  # pro rata
        (2, 10.0, 0.0, 0.0, True), (2, 10.0, 0.0, 0.0, True),  # kept zeros share equally
        (3, 10.0, 0.0, 0.0, False),  # zero
        (4, 10.0, 50.0, 50.0, False),  # whole
        (5, 10.0, 20.0, 0.0, False),  # zero total
        (6, 10.0, 0.0, 9.0, True),  # kept zero without a zero total
    )
    got = op.allocate(df, ["l"], "q", "part", "total", F.col("keep"), "x")
    assert rows(got, "l", "x") == [(1, 3.0), (1, 7.0), (2, 5.0), (2, 5.0), (3, 0.0), (4, 10.0), (5, 10.0), (6, None)]


def test_survival_curve(frame):
    exits = frame("age int", (1,), (2,), (2,), (9,))  # 1 is clipped up, 9 down
    censored = frame("age int", (3,), (99,))
    curve = op.survival_curve(exits, censored, "age", 2, 4)
    assert rows(curve.select("age", "n_events", "n_censored", "n_survivors", F.round("survival_rate", 6))) == [
        (2, 3, 0, 5, 0.4), (3, 0, 1, 2, 0.4), (4, 1, 0, 1, 0.0),
    ]


def test_survival_curve_without_anyone_at_risk_stays_flat(frame):
    curve = op.survival_curve(frame("age int", (2,)), frame("age int", (2,)), "age", 2, 4)
    assert rows(curve, "age", "instantaneous_death_rate", "survival_rate") == [(2, 0.5, 0.5), (3, None, 0.5), (4, None, 0.5)]


def test_forecast_exits(frame):
    curve = frame("age int, instantaneous_death_rate double", (50, 0.0), (51, 0.5), (52, 1.0))
    cohorts = frame("age int, g string, n int", (49, "x", 10), (50, "x", 10))
    got = op.forecast_exits(cohorts, curve, "g", "n", horizon=2)
    # Age 49 joins the curve from horizon 1 on; age 50 loses 0, then 5, then the rest.
    assert rows(got) == [(0, "x", 0.0), (1, "x", 5.0), (2, "x", 10.0)]


def test_decode_filters_the_domain(frame):
    df = frame("c string", ("1",), ("2",), (None,))
    codes = frame("code string, cf_descr string, nom_table string", ("1", "one", "A"), ("1", "uno", "B"), ("2", "dos", "B"))
    assert rows(op.decode(df, codes, "c", "A", "label")) == [("1", "one"), ("2", None), (None, None)]


def test_dense_days_and_fill(frame):
    df = frame("k string, a date, b date", ("x", "2020-02-28", "2020-03-01"))
    grid = op.dense_days(df, F.col("a"), F.col("b")).select("k", "day")
    facts = frame("k string, day date, n int", ("x", "2020-02-29", 7), ("x", "2020-03-01", None))
    assert rows(op.fill_missing(grid, facts, ["k", "day"], {"n": 0})) == [
        ("x", "2020-02-28", 0), ("x", "2020-02-29", 7), ("x", "2020-03-01", 0),
    ]


def test_quality_checks(frame):
    df = frame("k int, s string, v double", (1, "a", 0.5), (1, "b", 2.0), (None, "c", None), (None, "a", 0.0))
    assert rows(op.duplicate_keys(df, ["k"])) == [(1, 2), (None, 2)]
    assert op.null_rows(df, "v").count() == 1
    assert op.unexpected_values(df, "s", ["a", "b"]).count() == 1
    assert op.outside_range(df, "v", 0, 1).count() == 1
    assert op.outside_range(df, "v", 0, 1, inclusive=False).count() == 2
    report = op.quality_report(df, {"k": ["k"]}, ["v"], {"s": ["a"]}, {"v": (0, 1)})
    assert rows(report) == [("accepted_range:v", 1), ("accepted_values:s", 2), ("not_null:v", 1), ("unique:k", 2)]


def test_not_in_has_the_nulls_of_sql(spark, frame):
    df, some = frame("k int", (1,), (2,), (None,)), frame("v int", (2,), (2,))
    assert rows(op.not_in(df, "k", some, "v")) == [(1,)]
    assert rows(op.not_in(df, "k", some.unionByName(frame("v int", (None,))), "v")) == []
    assert rows(op.not_in(df, "k", some.filter("false"), "v")) == [(1,), (2,), (None,)]


def test_pieces_follow_the_rows_of_a_hot_key(spark, frame):
    """One row dated 9999, a hot hour, ties on the first order column, null keys: no piece holds a key."""
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        df = spark.range(30_000).select(
            F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 50 == 1, F.concat(F.lit("k"), "id")).otherwise("a").alias("k"),
            F.when(F.col("id") == 77, F.to_timestamp(F.lit("9999-12-31 00:00:00")))
            .when(F.col("id") < 300, F.timestamp_seconds(F.col("id") * 86400))
            .otherwise(F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") % 2)).alias("d"),
            F.col("id").alias("i"),
        )
        cuts = Cuts(df, ["k"], ["d", "i"], 1000)
        placed = df.withColumn("_part", cuts.piece())
        sizes = {(r.k, r._part): r["count"] for r in placed.groupBy("k", "_part").count().collect()}
        assert max(sizes.values()) < 30_000 / 8 and sum(sizes.values()) == 30_000
        assert len([1 for k, _ in sizes if k == "a"]) > 10 and len([1 for k, _ in sizes if k == "k51"]) == 1
        ordered = [r._part for r in placed.where("k = 'a'").orderBy("d", "i").collect()]
        assert ordered == sorted(ordered)
        summed = op.running_sum(df, ["k"], ["d", "i"], F.col("i"), "x")
        whole = op.running_sum(df, ["k"], ["d", "i"], F.col("i"), "x", chunk_rows=None)
        assert summed.exceptAll(whole).isEmpty() and summed.count() == 30_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    with pytest.raises(TypeError):
        Cuts(df.withColumn("k", F.array("k")), ["k"], ["d", "i"], 100)


def test_scans_shuffle_rows_once_and_read_few_columns_for_hot_keys(spark, tmp_path):
    """No join, no second shuffle of rows; cold keys take a plain window."""
    wide = spark.range(20_000).selectExpr("id % 2 AS k", "id AS i", "id * 0.5D AS v", "uuid() AS more")
    wide.write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    summed = op.running_sum(table, ["k"], ["i"], F.col("v"), "x")
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    whole, hot = sorted(scans, key=lambda line: "In(k, [0,1])" in line)
    assert "more:string" in whole and "more:string" not in hot and "In(k, [0,1])" in hot
    # The rows by key and piece; the few sums of the hot keys by key and piece, then by key.
    assert plan.count("Exchange hashpartitioning") == 3
    cold = op.running_sum(table, ["i"], ["v"], F.col("v"), "x")
    assert "Subquery" not in cold._jdf.queryExecution().executedPlan().toString()


def test_scans_of_several_key_types(spark):
    """Decimal, date, binary and null parts of keys and orders survive the literals."""
    df = spark.range(6000).selectExpr(
        "CAST(id % 3 AS DECIMAL(10,2)) / 3 AS a", "IF(id % 2 = 0, NULL, DATE '2020-02-29') AS b",
        "CAST(CAST(id % 977 AS STRING) AS BINARY) AS o", "id / 7.0D AS p", "IF(id % 5 = 0, id, NULL) AS v",
    )
    for scan, column in ((op.carry_forward, "v"), (op.previous_value, F.col("v")), (op.running_sum, F.col("v"))):
        cut = scan(df, ["a", "b"], ["o", "p"], column, "x")
        whole = scan(df, ["a", "b"], ["o", "p"], column, "x", chunk_rows=None)
        assert cut.dtypes == whole.dtypes and cut.exceptAll(whole).isEmpty(), scan
