from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from boardroll.params import Params
from boardroll.plans import pay

PARAMS = Params(as_of=date(2021, 6, 30), current_year=2020, pay_from=date(2020, 7, 1))

JOBS = (
    "matr string, date_eff date, sect string, aff string, lieu_trav string, corp_empl string, etat string, mode string, stat_eng string, "
    "ref_empl string, date_fin date, pourc_post double, pourc_sal double, pourc_temp double, nb_hre_sem double"
)


def job(matr, corp="3100", etat="A", mode="J", stat="R", salary=0.0, weekly=0.0):
    return (matr, "2020-01-01", "s", "f", "001", corp, etat, mode, stat, "1", "9999-12-31", 100.0, salary, 100.0, weekly)


@pytest.fixture
def classes(frame):
    return frame(
        "corp_empl string, date_deb date, date_fin date, nb_hres_an double",
        *[(c, "2019-01-01", "9999-12-31", 1300.0) for c in ("3100", "3500", "2100", "4100")],
        ("3100", "2000-01-01", "2018-12-31", 1.0),
    )


@pytest.fixture
def statuses(frame):
    return frame("etat_empl string, trait_spec string", ("A", "0"), ("S", "1"), ("U", "2"))


def test_perimeter(frame, classes, statuses):
    jobs = frame(
        JOBS,
        job("teacher"), job("special", stat="E2"), job("prof", "2100"), job("hourly", "4100", mode="h", weekly=35.0),
        job("support", "4100", mode="H", weekly=0.0), job("adult", "3500", etat="S", salary=80.0), job("unpaid", etat="U"), job("out", stat="91"),
    )
    got = pay.employment_perimeter(jobs.unionByName(jobs), classes, statuses, PARAMS)
    assert [(m, pytest.approx(h), y, s) for m, h, y, s in rows(got, "matr", "hntj", "nb_hres_an", "pourc_sabbatique_manquant")] == [
        ("adult", 6.5, 800.0, 20.0), ("hourly", 7.0, 1080.0, 100.0), ("prof", 1300 / 260.9, 1080.0, 100.0), ("special", 6.4, 1080.0, 100.0),
        ("support", 5.0, 1080.0, 100.0), ("teacher", 6.5, 1080.0, 100.0), ("unpaid", 6.5, 1080.0, 0.0),
    ]


def test_paid_hours(frame, classes, statuses):
    jobs = frame(JOBS, job("m"), job("s", etat="S", salary=80.0), job("u", etat="U"))
    perimeter = pay.employment_perimeter(jobs, classes, statuses, PARAMS)
    periods = frame("gr_paie string, an_budg string, no_per string, date_deb date, date_fin date, date_cheq date",
                    ("1", "20202021", "05", "2020-10-01", "2020-10-14", "2020-10-22"), ("1", "20192020", "05", "2019-10-01", "2019-10-14", "2019-10-22"))
    cheques = frame(
        "matr string, gr_paie string, no_cheq string, date_cheq date, etat_cheq int, an_budg string, no_per string",
        *[(m, "1", "9", "2020-10-22", 3, "20202021", "05") for m in "msu"],
        ("m", "1", "8", "2020-10-22", 2, "20202021", "05"), ("m", "1", "7", "2019-10-22", 3, "20192020", "05"),
    )

    def line(matr, seq, code="101000", mode="H", units="10", mnt="100", deferred="0", origin="B1", corp="3100", cheq="9", last="2020-10-02"):
        day = "2019-10-22" if cheq == "7" else "2020-10-22"
        return (matr, seq, code, corp, None, mode, units, "1", cheq, day, "2020-10-01", last, origin, mnt, deferred)

    payments = frame(
        "matr string, no_seq int, code_pmnt string, corp_empl string, lieu_trav string, mode string, nb_unit decimal(12,4), ref_empl string, "
        "no_cheq string, date_cheq date, date_deb date, date_fin date, code_prov string, mnt decimal(14,2), mnt_cour_trait_diff decimal(14,2)",
        line("m", 1), line("m", 2, mode="1", units="2"), line("m", 3, code="101500", units="4", mnt="0"), line("m", 4, mnt="0"),
        line("m", 5, code="103600"), line("m", 6, code="999999"), line("m", 7, origin="A6"), line("m", 8, mode=" "), line("m", 9, corp="9100"),
        line("m", 10, code="105001", origin="AX", units="61"), line("m", 11, code="105001", origin="AX", units="60"),
        line("m", 12, cheq="8"), line("m", 13, cheq="7"), line("m", 14),
        line("s", 1, deferred="5"), line("u", 1),
    )
    codes = frame("code_pmnt string, descr string", *[(c, "d") for c in ("101000", "101500", "103600", "105001")])
    exempted = frame("code_pmnt_a_exonerer string", ("103600",), ("101000",))
    account = "00112345678"
    raw = [("m", "2020-10-22", "9", n, account, a) for n, a in ((1, "60"), (2, "100"), (4, "0"), (11, "100"))]
    raw += [("m", "2020-10-22", "9", 1, "00212345678", "40"), ("m", "2020-10-22", "9", 3, account, "0"), ("m", "2020-10-22", "9", 3, "00212345678", "0")]
    raw += [("s", "2020-10-22", "9", 1, account, "105"), ("u", "2020-10-22", "9", 1, account, "100")]
    splits = pay.account_splits(frame("matr string, date_cheq date, no_cheq string, no_seq int, no_cmpt string, mnt_dist decimal(14,2)", *raw), PARAMS)
    kept = frame("code_pmnt string, descr string", ("101500", "CNESST"))
    got = pay.paid_hours_by_account(periods, cheques, payments, perimeter, codes, exempted, splits, kept, PARAMS)
    assert rows(got, "matr", "no_seq", "unite_admin", "nb_hre_remun_dist") == [
        ("m", 1, "001", 6.0), ("m", 1, "002", 4.0),  # shared over two accounts
        ("m", 2, "001", 13.0),  # two days of 6.5 hours
        ("m", 3, "001", 2.0), ("m", 3, "002", 2.0),  # no money, but a kept code
        ("m", 11, "001", 60.0),
        ("s", 1, "001", 12.5),  # paid at 80 %: ten hours stand for 12.5
    ]
    assert got.filter("matr = 'u'").isEmpty()
    first = got.filter("matr = 'm' AND no_seq = 1 AND unite_admin = '001'").first()
    assert (first.no_cmpt, first.annee, first.lieu_trav, first.typeremun) == ("001-1-23456-78", "2020", "001", "1")
    assert first.mnt_dist == Decimal("60.00")

    units = pay.admin_unit_names(
        frame("exer_fin string, code string, descr string", ("20202021", "001", "École"), ("20202021", "002", "Centre")),
        frame("current_lieu_trav string, new_lieu_trav string, new_descr string", ("001", "002", "Centre")),
    )
    assert rows(units, "current_lieu_trav", "new_lieu_trav", "descr") == [("001", "002", "centre"), ("002", "002", "centre")]
    report = pay.full_time_report(
        got.filter("matr = 'm'"), units, frame("job_group string, job_group_category string"), frame("corp_empl string, descr string", ("3100", "Ens")),
        frame("stat_eng string, descr_stat_eng string"),
    )
    assert report.select("cat_emploi", "stat_eng", "corp_emploi").distinct().collect()[0][:] == ("-", "R - ", "3100 - Ens")
    total = sum(r.nombre_heures_remun for r in report.collect())
    assert total == 6 + 4 + 13 + 2 + 2 + 60
    assert sum(r.equivalent_temps_plein for r in report.collect()) == pytest.approx(total / 1826.3)


def test_perimeter_is_spread_whatever_the_statuses(frame, classes, statuses, spark):
    """The rows of one status are not gathered in one task."""
    jobs = frame(JOBS, *[job(f"m{n}") for n in range(200)])
    with_small_broadcasts = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m"}
    before = {k: spark.conf.get(k, None) for k in with_small_broadcasts}
    for k, v in with_small_broadcasts.items():
        spark.conf.set(k, v)
    try:
        got = pay.employment_perimeter(jobs, classes, statuses, PARAMS)
        held = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(held) == 200
    assert max(held) < 20
