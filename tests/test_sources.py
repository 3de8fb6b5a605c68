from datetime import datetime

import pytest
from conftest import rows

from boardroll.plans.checks import CHECKS
from boardroll.sources import (
    CONTRACTS,
    LAYOUTS,
    PLACES,
    SEEDS,
    SOURCES,
    BadSeed,
    Catalog,
    Kept,
    Snapshots,
    Sources,
    Staging,
    code_labels,
    flag_codes,
    last_runs,
    parquet_tables,
    project,
    read_seed,
    saved_tables,
    stamp,
    write_table,
)
from boardroll.sources.sinks import Layout


def test_every_declared_schema_parses(spark):
    for ddl in [*CONTRACTS.values(), *SEEDS.values()]:
        assert spark.createDataFrame([], ddl).count() == 0
    assert len(SOURCES) == 25
    assert [c.type for c in SOURCES["i_pai_hchq_pmnt"].columns if c.name == "nb_unit"] == ["decimal(12,4)"]


def test_project_renames_types_and_prunes(frame):
    upstream = frame(
        "prog string, progmeq int, descrprog string, regimesanct string, typediplome string, extra int", ("p", 1, "d", "r", "DES", 9)
    )
    got = project(upstream, SOURCES["i_t_prog"])
    assert got.columns == ["prog", "prog_meq", "descr_prog", "regime_sanct", "type_diplome"]
    assert rows(got) == [("p", "1", "d", "r", "DES")]
    with pytest.raises(ValueError, match="typediplome"):
        project(upstream.drop("typediplome"), SOURCES["i_t_prog"])


def test_sources_read_and_override(spark, frame, tmp_path):
    frame("code_pmnt string, descr string", ("1", "x")).write.parquet(f"{tmp_path}/pai_tab_pmnt.parquet")
    mine = frame("code_pmnt string, descr string", ("2", "y"))
    readers = {"paie": parquet_tables(spark, str(tmp_path))}
    assert rows(Sources(spark, readers)["i_pai_tab_pmnt"]) == [("1", "x")]
    assert rows(Sources(spark, readers, overrides={"i_pai_tab_pmnt": mine})["i_pai_tab_pmnt"]) == [("2", "y")]
    mine.createOrReplaceTempView("pai_tab_pmnt")
    assert spark.catalog.currentDatabase() == "default"
    assert saved_tables(spark, "default") is not None


def test_seeds(spark, frame, tmp_path):
    (tmp_path / "q.csv").write_text("code,descr,is_qualified\nA,Brevet légal,true\nB,Autre,false\n", encoding="utf-8")
    seed = read_seed(spark, "ens_qualification", str(tmp_path / "q.csv"))
    assert rows(seed) == [("A", "Brevet légal", True), ("B", "Autre", False)]
    absent = read_seed(spark, "pmnt_zero_keep", None)
    df = frame("code string, label string", ("A", "x"), ("Z", "y"), (None, "z"))
    assert rows(flag_codes(df, seed, "code", "f"), "code", "f") == [("A", True), ("Z", False), (None, False)]
    assert rows(flag_codes(df, absent, "code", "f").select("f").distinct()) == [(False,)]
    assert rows(code_labels(df, "label", "code", ["A"])) == [("x",)]
    with pytest.raises(ValueError):
        code_labels(df, "label", "code", [])


def test_seed_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("IS_QUALIFIED,more,code,descr\ntrue,x,A,\"one, two\"\n,y,B,\n", encoding="utf-8")
    assert rows(read_seed(spark, "ens_qualification", str(path))) == [("A", "one, two", True), ("B", None, None)]
    path.write_text("code,descr\nA,x\n", encoding="utf-8")
    with pytest.raises(BadSeed, match="lacks is_qualified"):
        read_seed(spark, "ens_qualification", str(path))


def test_bad_cells_name_their_record_and_column(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("an_budg,nb_hres_an,nb_etc\n2020,12.5,3\n2021,many,4\n2022,1,2,3\n2023,,\n", encoding="utf-8")
    with pytest.raises(BadSeed) as failed:
        read_seed(spark, "cibles_etc", str(path))
    text = str(failed.value)
    assert "record 2: nb_hres_an holds many, no double" in text and "record 3: not one cell for each column" in text
    assert "record 1" not in text and "record 4" not in text
    path.write_text("etat_empl,descr,empl_retr,empl_cong,cong_lt,etat_actif,valid_from,valid_until\nA,x,1,0,0,1,2020-02-30,\n")
    with pytest.raises(BadSeed, match="record 1: valid_from holds 2020-02-30, no date"):
        read_seed(spark, "etat_empl", str(path))


def test_write_table_layout_and_refresh(spark, frame, tmp_path):
    df = frame("school_year int, matr string, v int", (2019, "a", 1), (2020, "b", 2), (2020, None, 3))
    layout = Layout(("school_year",), ("matr",))
    for _ in range(2):  # a second run replaces the first
        back = write_table(df, str(tmp_path), "t", layout)
    assert rows(back, "school_year", "matr", "v") == [(2019, "a", 1), (2020, "b", 2), (2020, None, 3)]
    assert back.dtypes == df.dtypes
    for version in (tmp_path / "t").iterdir():
        assert {p.name for p in version.glob("school_year=*")} == {"school_year=2019", "school_year=2020"}
    assert "PartitionFilters: [isnotnull(school_year" in back.filter("school_year = 2019")._jdf.queryExecution().toString()


def test_readers_see_the_last_good_version(spark, frame, tmp_path):
    """A write that fails midway, a write that is not committed, two tables that change together."""
    place, other = Snapshots(spark, str(tmp_path)), Snapshots(spark, str(tmp_path))
    with pytest.raises(KeyError):
        place.read("t")
    place.refresh(frame("a int", (1,), (2,)), "t")
    before = other.read("t")
    broken = spark.range(0, 4000, 1, 8).selectExpr("IF(id = 3999, raise_error('midway'), CAST(id AS INT)) AS a")
    for layout in (Layout(), Layout((), ("a",))):
        with pytest.raises(Exception, match="midway"):
            place.refresh(broken, "t", layout)
    assert rows(other.read("t")) == [(1,), (2,)]
    staged = place.stage(frame("a int", (3,)), "t")
    place.stage(frame("b int", (4,)), "u")
    assert rows(staged) == [(3,)] and rows(other.read("t")) == [(1,), (2,)] and other.tables() == ["t"]
    assert place.vacuum() >= 1  # what the broken writes have left; not what is staged
    place.commit()
    assert rows(other.read("t")) == [(3,)] and rows(other.read("u")) == [(4,)]
    assert rows(before) == [(1,), (2,)]  # a reader that has begun keeps its version
    assert place.vacuum() == 1 and rows(other.read("t")) == [(3,)]
    with pytest.raises(KeyError):
        place.commit(["t"])


def test_a_write_computes_its_plan_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(0, 1000, 1, 4).mapInPandas(look, "id long")
    back = write_table(df, str(tmp_path), "t", Layout((), ("id",)))
    assert back.count() == 1000 and seen.value == 1000


def _rows_scanned(df):
    """Rows that the scan has handed on; row groups that it skips hand on none."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(n).metrics().apply("numOutputRows").value() for n in range(leaves.size()))


def test_a_bloom_filter_skips_row_groups(spark, tmp_path):
    """Values in no order, so that least and greatest values skip nothing."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    jvm_conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm_conf.set("parquet.block.size", str(64 * 1024))
    try:
        df = spark.range(0, 120_000, 1, 1).selectExpr("xxhash64(id) AS fiche", "id AS v")
        read = {}
        for name, layout in (("plain", Layout()), ("filtered", Layout(lookup=("fiche",)))):
            table = write_table(df, str(tmp_path), name, layout)
            wanted = df.where("v = 77777").first()["fiche"]
            found = table.where(f"fiche = {wanted}L")
            assert [r.v for r in found.collect()] == [77777]
            read[name] = _rows_scanned(found)
        assert read["plain"] == 120_000 and read["filtered"] < 30_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        jvm_conf.unset("parquet.block.size")


def test_catalog_places_tables_under_their_names(spark, frame):
    places = {"jobs": ("b_hr", "jobs"), "main": ("b_hr", "main_jobs"), "far": ("b_rls", "jobs")}
    catalog = Catalog(spark, places, "t_")
    try:
        jobs = frame("matr string, school_year int", ("a", 2020), ("b", 2020))
        assert rows(catalog.refresh(jobs, "jobs", Layout(("school_year",), ("matr",)))) == [("a", 2020), ("b", 2020)]
        catalog.refresh(jobs.limit(1), "far")
        assert saved_tables(spark, "t_b_hr")("jobs").count() == 2 and saved_tables(spark, "t_b_rls")("jobs").count() == 1
        catalog.stage(jobs.limit(0), "jobs")
        assert saved_tables(spark, "t_b_hr")("jobs").count() == 2  # not yet shown
        catalog.commit()
        assert saved_tables(spark, "t_b_hr")("jobs").count() == 0
        assert catalog.vacuum("jobs") == 1 and saved_tables(spark, "t_b_hr")("jobs").count() == 0
        jobs.write.saveAsTable("t_b_hr.main_jobs")  # somebody else's
        with pytest.raises(ValueError, match="not written here"):
            catalog.refresh(jobs, "main")
        assert spark.table("t_b_hr.main_jobs").count() == 2
        with pytest.raises(KeyError):
            catalog.place("unknown")
    finally:
        for database in ("t_b_hr", "t_b_rls"):
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_two_tables_may_not_share_a_name():
    with pytest.raises(ValueError, match="would both be"):
        Catalog(None, {"a": ("hr", "Jobs"), "b": ("HR", "jobs")})
    assert len({(d, a) for d, a in PLACES.values()}) == len(PLACES)


def test_bucketed_tables_join_without_a_shuffle(spark):
    """activity_yearly and main_job_yearly, as they are laid out, on the employee."""
    from boardroll.catalog.derived import PARAMS
    from boardroll.catalog.plan_queries import DerivedInputs
    from boardroll.plans.board import Board

    board = Board(DerivedInputs(spark, "/root/testdata/sf0.001"), PARAMS)
    catalog = Catalog(spark, prefix="t_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = ("activity_yearly", "main_job_yearly")
        activity, main = (catalog.refresh(getattr(board, n), n, buckets=4) for n in names)
        joined = activity.join(main.select("matr", "main_job"), "matr")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = board.activity_yearly.join(board.main_job_yearly.select("matr", "main_job"), "matr")
        assert joined.count() == plain.count() > 0
        # At most one file for each bucket and folder.
        files = {tuple(f.rpartition("/")[::2]) for f in main.inputFiles()}
        assert len(files) <= 4 * len({folder for folder, _ in files})
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE IF EXISTS t_human_resources CASCADE")


def test_freshness(spark, tmp_path):
    stamp(spark, str(tmp_path), "absences", datetime(2021, 1, 1, 3))
    stamp(spark, str(tmp_path), "absences", datetime(2021, 1, 2, 3))
    assert rows(last_runs(spark, str(tmp_path))) == [("absences", "2021-01-02T03:00:00")]


def test_sources_resolve_contracts_and_seeds(spark, frame, tmp_path):
    frame("id_eco int, annee string, eco string, more int", (1, "2020", "001", 5)).write.parquet(f"{tmp_path}/i_gpm_t_eco.parquet")
    (tmp_path / "s.csv").write_text("lieu_trav,secteur_Id,secteur_Descr,ordre_Ens\n001,1,Nord,4\n", encoding="utf-8")
    inputs = Sources(spark, {}, parquet_tables(spark, str(tmp_path)), {"secteur": str(tmp_path / "s.csv")})
    assert rows(inputs["i_gpm_t_eco"]) == [(1, 2020, "001")]
    assert rows(inputs["secteur"], "lieu_trav", "secteur_Descr") == [("001", "Nord")]
    assert inputs["adjust_nomen_unit_adm"].isEmpty()  # an optional seed that is not there
    short = Sources(spark, {}, overrides={"i_gpm_t_eco": frame("id_eco int", (1,))})
    with pytest.raises(ValueError, match="lacks annee, eco"):
        short["i_gpm_t_eco"]
    with pytest.raises(KeyError):
        short["i_gpm_t_cal"]


def test_layouts_name_tables_and_their_columns(spark):
    from boardroll.catalog.derived import PARAMS
    from boardroll.catalog.plan_queries import TABLES, DerivedInputs
    from boardroll.plans.board import Board

    board = Board(DerivedInputs(spark, "/root/testdata/sf0.001"), PARAMS)
    for name, layout in LAYOUTS.items():
        assert name in TABLES
        assert {*layout.partition, *layout.cluster} <= {*getattr(board, name).columns}, name


def test_a_run_writes_checks_and_stamps(spark, tmp_path):
    from boardroll.catalog.derived import PARAMS
    from boardroll.catalog.plan_queries import DerivedInputs
    from boardroll.plans.run import ChecksFailed, run_report

    inputs, ended = DerivedInputs(spark, "/root/testdata/sf0.001"), datetime(2021, 1, 1)
    found = run_report(spark, inputs, PARAMS, str(tmp_path), "hr", ["main_job_yearly", "job_class_names"], ended)
    assert {r.table for r in found.collect()} == {"main_job_yearly", "job_class_names"} & set(CHECKS)
    assert list((tmp_path / "hr" / "main_job_yearly").glob("*/school_year=*"))
    good = Snapshots(spark, f"{tmp_path}/hr")
    assert {"_checks", "job_class_names", "main_job_yearly"} <= {*good.tables()}
    assert rows(last_runs(spark, str(tmp_path))) == [("hr", "2021-01-01T00:00:00")]
    twice = {"i_pai_tab_lieu_trav": spark.createDataFrame([("001", "a"), ("001", "b"), (None, "c")], "lieu_trav string, descr string")}
    with pytest.raises(ChecksFailed):
        run_report(spark, twice, PARAMS, str(tmp_path), "rls", ["workplaces"], ended)
    assert last_runs(spark, str(tmp_path)).count() == 1
    failed = Snapshots(spark, f"{tmp_path}/rls")
    assert failed.tables() == ["_checks"] and not failed.read("_checks").where("n_failures > 0").isEmpty()


def test_staging_uses_one_folder_per_run(spark, frame, tmp_path):
    df = frame("a int, b string", (1, "x"), (2, None))
    first, second = Staging(spark, str(tmp_path)), Staging(spark, str(tmp_path))
    assert rows(first.save(df, "t")) == rows(second.save(df.limit(1), "t")) + [(2, None)]
    first.clear()
    assert len(list((tmp_path / "boardroll").iterdir())) == 1
    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(ValueError, match="name a folder"):
            Staging(spark)


def test_kept_tables_are_let_go(spark, frame):
    kept = Kept()
    table = kept.save(frame("a int", (1,)), "t")
    assert table.count() == 1 and table.is_cached
    kept.clear()
    assert not table.is_cached
