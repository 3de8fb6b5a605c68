"""Steps over large inputs deal their rows to many partitions, whatever adaptive execution would merge."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from boardroll.catalog import derived, plan_queries
from boardroll.operators import allocate, dealt, headcount, in_lanes, join_codes, laned, point_in_interval_join, quality_report, unlaned
from boardroll.operators.dealing import LANE, PARTS, grouped
from boardroll.plans import pay
from boardroll.plans.checks import CHECKS
from boardroll.sources import flag_codes


def _dealings(df):
    return df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM")


def test_dealt_keeps_its_partitions(spark):
    assert dealt(spark.range(100), "id").rdd.getNumPartitions() == PARTS


def test_headcount_deals_stays_by_member(frame):
    stays = frame("school string, pupil int, start date, end date", ("a", 1, "2020-01-01", "2020-01-03"), ("a", 2, "2020-01-01", "2020-01-05"))
    counted = headcount(stays.unionByName(stays), ["school"], "start", "end", "pupil")
    assert _dealings(counted) == 1
    assert rows(counted, "school", "day", "headcount") == [("a", "2020-01-01", 2), ("a", "2020-01-03", 1), ("a", "2020-01-05", 0)]


def test_fine_interval_join_deals_both_sides(frame):
    points = frame("k string, at date", ("a", "2020-01-02"), ("a", "2022-01-02"), (None, "2020-01-02"), ("b", None))
    spans = frame("k string, first date, last date, v int", ("a", "2020-01-01", "2020-12-31", 1), ("a", "2019-01-01", "2020-01-02", 2))
    fine, plain = [point_in_interval_join(points, spans, ["k"], "at", "first", "last", how="left", fine=f) for f in (True, False)]
    assert _dealings(fine) == 2
    assert rows(fine) == rows(plain)
    assert len(rows(fine)) == 5


def test_large_orders_and_lines_are_dealt_by_order(spark, tmp_path, monkeypatch):
    spark.sql(
        "SELECT id AS o_orderkey, id % 5 AS o_custkey, timestamp'2000-01-01' + make_dt_interval(CAST(id AS INT)) AS o_orderdate FROM range(60)"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql(
        "SELECT id % 60 AS l_orderkey, id AS l_partkey, id AS l_linenumber, 'A' AS l_returnflag, 'F' AS l_linestatus, "
        "CAST(1 AS DOUBLE) AS l_quantity, CAST(2 AS DOUBLE) AS l_extendedprice FROM range(200)"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("SELECT id AS c_custkey, id AS c_nationkey, 'BUILDING' AS c_mktsegment FROM range(5)").write.parquet(str(tmp_path / "customer.parquet"))
    names = ("src_lines", "src_visits")
    whole = {n: rows(derived.Derived(spark, str(tmp_path))[n]) for n in names}
    spark.catalog.clearCache()
    monkeypatch.setattr(derived, "_ROWS", 25)
    cut = derived.Derived(spark, str(tmp_path))
    assert {n: rows(cut[n]) for n in names} == whole
    assert _dealings(cut["src_lines"]) or cut["src_lines"].rdd.getNumPartitions() == 8
    assert cut["src_visits"].rdd.getNumPartitions() == 3
    spark.catalog.clearCache()


@pytest.fixture
def sorted_joins(spark):
    """Joins by sorting over 50 partitions that are not merged."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "50",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _held(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_codes_gives_the_rows_of_a_plain_join(frame, how):
    big = frame("code string, k int", ("a", 1), ("a", 1), ("a", None), ("b", 2), (None, 3), ("c", 4))
    small = frame("code string, v int", ("a", 1), ("a", 2), ("b", None), (None, 9), ("d", 5))
    got, plain = join_codes(big, small, "code", "k", how=how), big.join(small, "code", how)
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


def test_flag_codes_flags_the_same_rows_when_spread(frame):
    big = frame("k int, code string", (1, "a"), (1, "a"), (None, "b"), (2, None), (3, "c"))
    for listed in ([("a", 1), ("a", 2), (None, 3)], [(None, 3)], []):
        codes = frame("code string, v int", *listed)
        got, plain = flag_codes(big, codes, "code", "kept", "k"), flag_codes(big, codes, "code", "kept")
        assert got.columns == plain.columns
        assert rows(got) == rows(plain)


def test_lines_of_one_code_are_not_gathered_in_one_task(spark, sorted_joins):
    """Neither by the lookup of codes that count, nor by the flag of kept codes."""
    lines = spark.range(2000).selectExpr(
        "CAST(id AS STRING) AS matr", "CAST(id AS STRING) AS no_cheq", "1 AS no_seq", "'101000' AS code_pmnt", "'3100' AS corp_empl",
        "'H' AS mode", "CAST(1 AS DECIMAL(12,4)) AS nb_unit", "'B1' AS code_prov",
    )
    codes, none = spark.sql("SELECT '101000' AS code_pmnt"), spark.sql("SELECT '103600' AS code_pmnt_a_exonerer")
    for spread in (pay._counted_payments(lines, codes, none), flag_codes(lines, codes, "code_pmnt", "kept", "matr", "no_cheq")):
        held = _held(spread)
        assert sum(held) == 2000
        assert max(held) < 400


def test_jobs_of_one_status_are_not_gathered_in_one_task(spark, sorted_joins):
    jobs = spark.range(2000).selectExpr("CAST(id AS STRING) AS matr", "'A1' AS etat")
    statuses = spark.sql("SELECT 'A1' AS etat, '0' AS trait_spec")
    held = _held(join_codes(jobs, statuses, "etat", "matr"))
    assert sum(held) == 2000
    assert max(held) < 400


def _shuffles(df):
    """Shuffles by name: of the plan's own making, and by lane."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("direct_shuffle_partition_id")


def test_laned_tables_and_lookups_meet_in_place(frame, sorted_joins):
    lines = frame("k string, code string, v int", ("a", "x", 1), ("a", "y", 2), ("b", "x", 3), (None, "x", 4), ("c", None, 5))
    jobs = frame("k string, day string, w int", ("a", "d", 6), ("a", "e", 7), ("b", "d", 8), (None, "d", 9))
    codes = frame("code string, label string", ("x", "X"), ("x", "X2"), (None, "none"))
    placed = join_codes(laned(lines, "k"), codes, "code", "k").join(laned(jobs, "k", otherwise=["day"]), ["k", LANE])
    counted = placed.groupBy("k", "day", LANE).agg(F.count("*").alias("n"))
    assert _shuffles(counted) == (0, 3)
    plain = lines.join(codes, "code").join(jobs, "k").groupBy("k", "day").agg(F.count("*").alias("n"))
    assert rows(counted.drop(LANE)) == rows(plain)
    again = unlaned(counted, "k").join(in_lanes(codes).select(LANE).distinct(), F.lit(False), "left_anti")
    assert LANE not in again.columns


def test_unlaned_rows_are_not_dealt_twice(frame, sorted_joins):
    table = unlaned(laned(frame("k string, v int", ("a", 1), (None, 2), (None, 3)), "k", otherwise=["v"]), "k", otherwise=["v"])
    assert table.columns == ["k", "v"]
    assert _shuffles(laned(table, "k", otherwise=["v"])) == (0, 1)
    assert _shuffles(laned(table, "v")) == (0, 2)
    assert _shuffles(grouped(table, "k", "v").count()) == (0, 1)
    # Rows of the null key lie apart, so that a grouping by it alone deals them.
    assert rows(grouped(table, "k").count()) == [("a", 1), (None, 2)]


def test_rows_without_a_key_are_spread(spark):
    jobs = spark.range(2000).selectExpr("CAST(NULL AS STRING) AS k", "id AS v")
    assert max(_held(laned(jobs, "k", otherwise=["v"]))) < 400


def test_allocation_reads_its_rows_once(frame, spark):
    lines = spark.range(4).selectExpr("id % 2 AS line", "CAST(id % 2 AS INT) AS part", "0 AS total", "10 AS hours")
    shared = allocate(lines, ["line"], "hours", "part", "total", F.lit(True))
    assert shared._jdf.queryExecution().optimizedPlan().toString().count("Range") == 1
    assert rows(shared, "line", "allocated") == [(0, 5.0), (0, 5.0), (1, 10.0), (1, 10.0)]
    loose = frame("line string, part int, total int, hours int", (None, 0, 0, 10), ("a", 0, 0, 10))
    assert rows(allocate(loose, ["line"], "hours", "part", "total", F.lit(True)), "line", "allocated") == [("a", 10.0), (None, None)]


def test_paid_hours_and_report_shuffle_each_table_once(spark, sorted_joins):
    """Nothing is dealt by hash, but lanes: payments, cheques, jobs and splits once each, and the hours for the report."""

    def table(*columns):
        return spark.range(40).selectExpr(*[c if " AS " in c else f"CAST(id AS STRING) AS {c}" for c in columns])

    day, end = "DATE'2020-10-22' + CAST(id AS INT)", "DATE'2021-10-22' + CAST(id AS INT)"
    perimeter = table("matr", f"{day} AS date_eff", f"{end} AS date_fin", "lieu_trav", "ref_empl", "stat_eng", "sect", "aff", "etat_empl", "8D AS hntj",
                      "9D AS nb_hres_an", "100D AS pourc_post", "100D AS pourc_temp", "100D AS pourc_sabbatique_manquant")
    payments = table("matr", "CAST(id AS INT) AS no_seq", "concat('10100', id) AS code_pmnt", "'3100' AS corp_empl", "lieu_trav", "'H' AS mode",
                     "CAST(id AS DECIMAL(12,4)) AS nb_unit", "ref_empl", "no_cheq", f"{day} AS date_cheq", f"{day} AS date_deb", f"{day} AS date_fin", "'B1' AS code_prov",
                     "CAST(id AS DECIMAL(14,2)) AS mnt", "CAST(id AS DECIMAL(14,2)) AS mnt_cour_trait_diff")
    periods = table("gr_paie", "an_budg", "no_per", f"{day} AS date_deb", f"{end} AS date_fin", f"{day} AS date_cheq")
    cheques = table("matr", "gr_paie", "no_cheq", f"{day} AS date_cheq", "3 AS etat_cheq", "an_budg", "no_per")
    codes, reasons = table("code_pmnt").limit(3), table("code_pmnt_a_exonerer").limit(3)
    params = plan_queries.PARAMS
    splits = pay.account_splits(table("matr", f"{day} AS date_cheq", "no_cheq", "CAST(id AS INT) AS no_seq", "no_cmpt", "CAST(id AS DECIMAL(14,2)) AS mnt_dist"), params)
    hours = pay.paid_hours_by_account(periods, cheques, payments, perimeter, codes, reasons, splits, codes, params)
    units = table("exer_fin", "current_lieu_trav", "new_lieu_trav", "descr")
    report = pay.full_time_report(hours, units, table("job_group", "job_group_category"), table("corp_empl", "descr"), table("stat_eng", "descr_stat_eng"))
    assert _shuffles(splits) == (0, 1)
    for df in (hours, report):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for key in ("matr", "no_cheq", "gr_paie", "no_cmpt", "an_budg", "corp_emploi", "stat_eng"):
            assert f"hashpartitioning({key}" not in plan


def test_checks_of_the_report_read_it_once_and_in_place(frame, sorted_joins):
    assert CHECKS["full_time_report"].passes == 1

    class Board:
        full_time_report = frame(", ".join(f"{c} string" for c in CHECKS["full_time_report"].key), ("x",) * 10, ("x",) * 10)

        def shared(self, name):
            raise AssertionError("kept although it is read once")

    assert rows(plan_queries._checked("full_time_report")(Board())) == [("unique:key", 1)]
    table = unlaned(laned(Board.full_time_report, "no_cmpt"), "no_cmpt")
    checked = quality_report(table, {"key": CHECKS["full_time_report"].key})
    assert _shuffles(checked) == (0, 1)
    assert rows(checked) == [("unique:key", 1)]
