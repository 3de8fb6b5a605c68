"""Pupils, adults, employment, retirement and qualifications on small frames."""

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from boardroll.params import Params
from boardroll.plans import access, addresses, adults, employment, qualifications, retirement, students

PARAMS = Params(as_of=date(2021, 6, 30), current_year=2020)


def test_diplomas(frame):
    mentions = frame(
        "code_perm string, fiche int, eco_cen_off string, prog_charl string, regime_sanct_charl string, ind_reus_sanct_charl string, date_obt_mention string, date_exec_sanct string",
        ("a", 1, "e", "P", "r", "O", "d", "202008"), ("a", 1, "e", "P", "r", "N", "d", "202009"), ("a", 1, "e", "Q", "r", "N", "d", "202009"),
    )
    programmes = frame("prog_meq string, type_diplome string", ("P", "CFMS"))
    got = students.diplomas(mentions, programmes)
    assert rows(got, "annee", "ind_obtention", "indice_cfms", "indice_des") == [(2019, 1.0, 1.0, 0.0), (2020, 0.0, 1.0, 0.0)]


@pytest.mark.parametrize(
    ("level", "cycle", "year", "classe", "label"),
    [("3", "2", "8", "E", "Prim 4"), ("3", "3", "7", "G", "Prim 5"), ("1", None, None, None, "Mat 4"), ("2", None, None, None, "Mat 5"),
     ("4", "1", "2", None, "Sec 2"), ("4", "1", "3", "3", "Sec 3"), ("4", "2", "2", "3", "Sec 3"), ("4", "2", "9", None, "Sec 5"),
     ("4", "2", "5", "8", "Sec 5"), ("4", "9", "1", None, "-"), (None, "1", "1", "A", "-")],
)
def test_grade_label(frame, level, cycle, year, classe, label):
    df = frame("ordre_ens string, cycle_ref string, annee_cycle_ref string, classe string", (level, cycle, year, classe))
    assert df.select(students.grade_label()).first()[0] == label


def test_repeaters(frame):
    df = frame(
        "fiche int, annee int, id_eco int, ordre_ens string, cycle_ref string, annee_cycle_ref string, classe string, population string",
        (1, 2018, 1, "3", "1", "8", "C", "x"),
        (2, 2018, 1, "4", "1", "1", "1", "Sec. régulier"), (2, 2019, 2, "4", "1", "1", "1", "Sec. régulier"),
        (3, 2018, 1, "4", "1", "1", "1", "Adapté"), (3, 2019, 2, "4", "1", "1", "1", "Adapté"),
        (4, 2018, 1, "2", None, None, "M", "x"), (4, 2019, 2, "2", None, None, "M", "x"),
    )
    got = df.select("fiche", "annee", students.repeats_year().alias("r"))
    assert rows(got.filter("r = 1"), "fiche", "annee") == [(1, 2018), (2, 2019), (4, 2019)]


def test_addresses(frame):
    ddl = (
        "fiche int, type_adr string, date_effect date, date_fin date, ind_envoi_meq int, no_civ string, orient_rue string, "
        "genre_rue string, rue string, ville string, code_post string"
    )

    def address(fiche, kind, start, meq, city, end="2099-01-01"):
        return (fiche, kind, start, end, meq, "1", None, "rue", "r", city, "H")

    df = frame(
        ddl,
        address(1, "P", "2018-09-15", 0, "A"),  # first address: kept whatever its mark
        address(1, "M", "2019-10-15", 0, "B"),  # two types and no official mail: left out
        address(1, "P", "2020-03-01", 1, "C"),
        address(2, "P", "2020-10-15", 0, "D"),
        address(2, "P", "2020-11-15", 0, "E"),  # one type: kept
        address(3, "P", "2020-10-15", 0, "F", "2020-10-15"),  # empty interval
        address(3, "P", "2020-10-15", 0, "F", None),  # no end date: left out
    )
    got = addresses.yearly_addresses(df, PARAMS)
    assert rows(got, "fiche", "annee", "last_ville", "ville__30sept") == [
        (1, 2018, "A", "A"), (1, 2019, "C", "A"), (1, 2020, "C", "C"), (2, 2020, "E", None),
    ]


def test_population_predicate(frame):
    pupils = frame("fiche int, id_eco int, ordre_ens string", (1, 10, "3"), (1, 10, "3"), (2, 10, "4"), (3, 99, "3"))
    years = frame("id_eco int, annee int, eco string", (10, 2020, "960"))
    people = frame("fiche int, code_perm string", (1, "a"), (2, "b"))
    assert students.population(pupils, years, people).count() == 3
    got = students.population(pupils, years, people, F.col("ordre_ens") == "3")
    assert rows(got) == [("a", 10, 2020), (None, 99, None)]


def _report(frame):
    cols = (
        "population string, etat_formation string, an int, raison_depart string, service_enseign string, programme string, "
        "organisation_horaire string, desc_type_parcours string, service_enseignement string, nom_centre string, genre string, desc_raison_depart string"
    )
    general = "Formation générale des adultes"
    return frame(
        cols,
        (general, "Terminé", 2020, "04", "01", "P", None, "T", "S", "C", "Fille", "r"),
        (general, "Terminé", 2020, "9", "01", "P", "", "T", "S", "C", "Fille", "q"),
        (general, "En cours", 2020, "04", "01", "P", "", "T", "S", "C", "Fille", "r"),
        ("Formation professionnelle", "Terminé", 2020, "04", "01", "P", "", "T", "S", "C", "Fille", "r"),
    ).withColumnRenamed("an", "année")


def test_success_rates(frame):
    got = adults.general_success_rates(_report(frame), PARAMS)
    total = got.filter(" AND ".join(f"{d} = 'Tous'" for d in adults.GENERAL_DIMS))
    assert rows(total, "nombre_total", "nombre_total_by_reussite", "taux") == [(2, 1, 0.5)]
    # Only the success row's cells and totals remain: 2^7 filters.
    assert got.count() == 128 and got.select("id_filtre").distinct().count() == 128
    assert rows(got.select("organisation_horaire").distinct()) == [("-",), ("Tous",)]
    without = Params(as_of=PARAMS.as_of, current_year=2020, excluded_services=("1",))
    assert adults.general_success_rates(_report(frame), without).isEmpty()


def test_success_list_shares_its_filters_with_the_rates(frame):
    report = _report(frame)
    for name in set(adults.LISTED) - set(report.columns):
        report = report.withColumn(name, F.lit("x"))
    listed = adults.general_success_list(report, PARAMS)
    rates = adults.general_success_rates(report, PARAMS)
    assert listed.count() == 128
    assert listed.join(rates, "id_filtre", "left_anti").isEmpty()
    assert rows(listed.select("organisation_horaire_bis").distinct()) == [(None,)]


def test_adult_students_do_not_multiply(frame):
    pop = frame("code_perm string, fiche int", ("a", 1), ("a", 2))
    people = frame(
        "code_perm string, nom string, prenom string, date_naissance string, ind_lieu_naissance_n string, lang_matern string, genre string",
        ("a", "Roy", "Li", "20000101", "1", "L", "F"), ("a", "Zed", None, "19990101", "1", "L", "F"),
    )
    homes = frame("fiche int, ville string, code_post string, envoimeq string, date_fin string",
                  (1, "V1", "H", "1", ""), (2, "V2", "H", "1", ""), (2, "V9", "H", "1", "20200101"))
    codes = frame("code string, cf_descr string, nom_table string", ("L", "Langue", "X_Lang"))
    got = adults.adult_students(pop, people, homes, codes)
    assert rows(got, "nom_prenom_code_perm", "date_naissance", "ville", "genre", "desc_lang_matern") == [
        ("Zed, Li (a )", "20000101", "V2", "Fille", "Langue"),
    ]


JOBS = "matr string, ref_empl string, corp_empl string, etat string, lieu_trav string, stat_eng string, date_eff date, date_fin date"


def test_activity_history(frame):
    jobs = frame(
        JOBS,
        ("m", "1", "3100", "A", "001", "R", "2019-07-01", "2020-06-26"),  # ends on a Friday
        ("m", "1", "3100", "A", "001", "R", "2020-06-29", "9999-12-31"),  # Monday, open end
        ("m", "1", "3100", "B", "001", "R", "2020-01-01", "2020-02-01"),  # other attributes
    )
    got = employment.activity_history(jobs, PARAMS)
    assert rows(got, "etat_empl", "school_year", "date_eff", "date_fin") == [
        ("A", 2019, "2019-07-01", "2021-06-30"), ("B", 2019, "2020-01-01", "2020-02-01"),
    ]


def test_main_jobs_and_fallbacks(frame):
    history = frame(
        "matr string, school_year int, ref_empl string, corp_empl string, etat_empl string, stat_eng string, lieu_trav string, date_eff date, date_fin date",
        *[(m, 2020, r, "3100", "A", "R", "001", "2020-07-01", "2021-06-30") for m, r in
          [("log", "1"), ("log", "2"), ("only", "7"), ("pref", "1"), ("pref", "2"), ("last", "1"), ("last", "2")]],
        ("old", 2018, "1", "3100", "A", "R", "001", "2018-07-01", "2020-08-01"),
        ("off", 2020, "1", "3100", "Z", "R", "001", "2020-07-01", "2021-06-30"),
    )
    statuses = frame("etat_empl string, school_year int, etat_actif int, empl_retr int", *[("A", y, 1, 0) for y in (2018, 2020)], ("Z", 2020, 0, 1))
    mains = frame("matr string, school_year int, main_job string", ("log", 2020, "1"))
    current = frame("matr string, ref_empl string, ind_empl_princ int", ("pref", "1", 1), ("pref", "1", 1), ("log", "2", 1))
    yearly = employment.activity_yearly(history, statuses, mains, current, PARAMS)
    assert rows(yearly.filter("is_main_job = 1 AND school_year = 2020"), "matr", "ref_empl") == [
        ("last", "2"), ("log", "1"), ("old", "1"), ("only", "7"), ("pref", "1"),
    ]
    assert rows(yearly.filter("matr = 'old'"), "school_year") == [(2018,), (2019,), (2020,)]
    paid = frame("matr string, last_pay_date date", ("log", "2021-06-17"), ("only", "2021-06-16"))
    assert rows(employment.activity_current(yearly, paid, PARAMS), "matr") == [("log",)]
    spans = frame("school_year int, matr string, main_job string, valid_from date, valid_until date",
                  (2019, "x", "1", "2019-09-01", "2020-09-01"), (2020, "x", "2", "2020-09-01", "2021-06-30"))
    assert rows(employment.main_job_yearly(spans, PARAMS)) == [("x", 2019, "1"), ("x", 2020, "2")]


def test_seniority_runs_over_years_and_restarts_after_a_gap(frame):
    history = frame(
        "matr string, school_year int, ref_empl string, corp_empl string, etat_empl string, stat_eng string, lieu_trav string, date_eff date, date_fin date",
        ("m", 2018, "1", "3100", "A", "R", "1", "2019-06-01", "2019-07-31"),
        ("m", 2019, "1", "3100", "A", "R", "1", "2019-08-01", "2019-08-31"),
        ("m", 2020, "1", "3100", "A", "R", "1", "2020-09-01", "2020-09-11"),
    )
    years = [("A", y, 1, 0) for y in (2018, 2019, 2020)]
    statuses = frame("etat_empl string, school_year int, etat_actif int, empl_retr int", *years)
    engaged = frame("stat_eng string, school_year int, is_reg int", *[("R", y, 1) for y in (2018, 2019, 2020)])
    mains = frame("matr string, main_job string, valid_from date, valid_until date", ("m", "1", "2019-06-11", "2021-06-30"))
    groups = frame("job_group string, job_group_category string", ("3100", "Ens"))
    got = employment.seniority(history, statuses, engaged, mains, groups, PARAMS)
    assert rows(got, "school_year", "running_experience", "valid_until") == [
        (2018, 19, "2019-06-30"), (2019, 49, "2019-07-31"), (2019, 79, "2019-08-31"), (2020, 10, "2020-09-11"),
    ]


def test_retirement_chain(frame):
    history = frame(
        "matr string, school_year int, ref_empl string, corp_empl string, etat_empl string, stat_eng string, lieu_trav string, date_eff date, date_fin date",
        ("a", 2015, "1", "3100", "Z", "R", "1", "2015-12-31", "2016-01-01"),
        ("a", 2016, "1", "3100", "Z", "R", "2", "2017-01-01", "2017-01-02"),
    )
    statuses = frame("etat_empl string, school_year int, etat_actif int, empl_retr int", ("Z", 2015, 0, 1), ("Z", 2016, 0, 1))
    people = frame("matr string, birth_date date, genre string", ("a", "1950-12-31", "F"), ("b", "1966-03-01", "F"), ("c", "1966-03-01", "M"))
    retired = retirement.retirements(history, statuses, people)
    assert rows(retired, "matr", "lieu_trav", "retirement_date", "retirement_age") == [("a", "2", "2017-01-01", 67)]
    files = frame(
        "matr string, date_nais date, date_entr date, date_dern_paie date, sexe string",
        ("a", "1950-12-31", "1980-01-01", "2017-01-01", "F"), ("b", "1966-03-01", "1990-01-01", "2021-06-20", "F"),
        ("c", "1966-03-01", "1990-01-01", "2021-06-20", "M"), ("d", "1950-01-01", "2010-01-01", "2012-01-01", "M"),
    )
    curve = retirement.survival_curve(files, retired)
    assert curve.count() == 21 and curve.filter("survival_rate NOT BETWEEN 0 AND 1").isEmpty()
    assert rows(curve.filter("age IN (55, 67)"), "n_censored", "n_events", "n_survivors") == [(0, 1, 1), (2, 0, 3)]
    groups = frame("job_group string, job_group_category string", ("3100", "Ens"), ("4100", "Sou"))
    current = frame("matr string, corp_empl string, etat_empl string, lieu_trav string, stat_eng string",
                    ("a", "3100", "A", "1", "R"), ("b", "3100", "A", "1", "R"), ("c", "9999", "A", None, "R"))
    forecast = retirement.retirement_forecasts(current, retired, files, groups, curve, PARAMS)
    assert forecast.count() == 12 and forecast.agg(F.sum("n_retiring_employees")).first()[0] == 0
    ages = retirement.active_age_report(current, retired, people, groups, PARAMS)
    assert rows(ages, "job_group_category", "lieu_trav", "age", "n_employees") == [("Ens", "1", 54, 1), ("Inconnu", "Inconnu", 54, 1)]
    report = retirement.observed_and_forecast_report(forecast, retired, groups, PARAMS)
    assert rows(report.filter("is_forecast = 0"), "school_year", "observed_retiring_employes") == [("2016-07-01", 1)]


def test_teacher_qualifications(frame):
    current = frame("matr string, corp_empl string, etat_empl string, lieu_trav string, stat_eng string",
                    ("a", "3100", "A", "1", "R"), ("b", "3100", "A", "1", "R"), ("c", "2100", "A", "1", "R"))
    statuses = frame("etat_empl string, descr string, etat_actif int", ("A", "Actif", 1))
    held = frame("matr string, type_qualif string, date_expir date",
                 ("a", "Q", "2021-07-01"), ("a", "Q", "2022-07-01"), ("a", "P", None), ("b", "Q", "2020-01-01"))
    got = qualifications.teacher_qualifications(current, statuses, held, PARAMS)
    assert rows(got, "matr", "type_qualif", "date_expir") == [("a", "P", None), ("a", "Q", "2022-07-01"), ("b", None, None)]
    report = qualifications.qualification_report(
        got,
        frame("matr string, legal_name string, sex_friendly_name string, birth_date date", ("a", "A", "Femme", "1996-12-31"), ("b", "B", "homme", "1956-01-01")),
        frame("workplace string, workplace_name string", ("1", "École")),
        statuses,
        frame("code_job string, code_job_name string", ("3100", "3100 - (x)")),
        frame("code string, statut string", ("R", "Régulier")),
        frame("code string, descr string, is_qualified boolean", ("Q", "Brevet", True), ("P", "Tolérance", False)),
        PARAMS,
    )
    assert rows(report, "matricule", "qualification", "edb", "endb", "tranche_age", "secteur") == [
        ("a", "Brevet", 1, 0, "25 à 34 ans", None), ("a", "Tolérance", 0, 1, "25 à 34 ans", None), ("b", "Aucune", 0, 1, "65 ans et plus", None),
    ]


def test_manager_schools(frame):
    ddl = (
        "cle_organisationnelle string, compte_authentification string, nom string, prenom string, ecoles string, corps_emploi string, "
        "ecole_principale string, description_corps_emploi_principal string"
    )

    def account(name, schools, job, main):
        return (name, name, "n", "p", schools, job, main, "d")

    df = frame(ddl, account("a", "001, 002", "100", "002"), account("b", "001", "100", "009"), account("c", " ", "100", "009"),
               account("d", None, "100", None), account("e", "001", "200", "001"), account("f", "001", "100", None))
    got = access.manager_schools(df)
    assert rows(got, "compte_authentification", "ecole") == [("a", " 002"), ("a", "001"), ("b", "001"), ("b", "009"), ("c", "009"), ("f", "001")]
