"""The absence chain on hand-worked frames."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from conftest import rows

from boardroll.operators import duplicate_keys
from boardroll.params import Params
from boardroll.plans import absence_reports, absences

PARAMS = Params(as_of=date(2021, 3, 31), current_year=2020, years_of_absences=1)


@pytest.fixture
def pupils(frame):
    return frame(
        "fiche int, id_eco int, ordre_ens string, grp_rep string, dist string, class string, date_debut date, date_depart date, grille string",
        (1, 10, "3", "101", "D1", "C1", "2020-08-30", None, "A"),
        (2, 10, "4", "102", None, "C1", "2020-10-05", "2021-02-01", "A"),
    )


@pytest.fixture
def calendar(frame):
    # 2021-03-01 is a Monday. Saturday and Sunday are no school days; the 9th has no period.
    def day(text, cycle="J", *periods):
        return (10, text, "A", cycle, *periods)

    short = frame(
        "id_eco int, date_evenement date, grille string, jour_cycle string, per_01 int, per_02 int, per_20 int",
        day("2021-03-04", "J", 1, 1, 1),
        day("2021-03-05", "J", 1, 1, 1),
        day("2021-03-06", None, None, None, None),
        day("2021-03-07", None, None, None, None),
        day("2021-03-08", "J", 1, 1, 1),
        day("2021-03-09", "J", None, None, None),
        day("2021-03-10", "J", 1, 1, 1),
    )
    return with_all_periods(short)


def with_all_periods(df):
    absent = [f"per_{i:02d}" for i in range(1, 21) if f"per_{i:02d}" not in df.columns]
    return df.withColumns({c: F.lit(None).cast("int") for c in absent})


def test_a_calendar_without_a_period_column_is_refused(calendar):
    with pytest.raises(ValueError, match="per_07, per_13"):
        absences.expected_periods(calendar.drop("per_07", "per_13"), PARAMS)


@pytest.fixture
def terms(frame):
    return frame(
        "fiche int, id_eco int, etape string, etape_description string, seq_etape int, date_debut date, date_fin date",
        (1, 10, "1", "Étape 1", 1, "2020-08-30", "2020-12-31"),
        (1, 10, "2", "Étape 2", 2, "2021-01-01", "2021-03-07"),
        (2, 10, "1", "Étape 1", 1, "2020-08-30", "2020-12-31"),
        (2, 10, "2", "Étape 2", 2, "2021-01-01", "2021-06-23"),
        (2, 10, "9", "Sommaire", 9, "2020-08-30", "2021-06-23"),
    )


@pytest.fixture
def daily(frame, pupils, calendar, terms):
    def hit(n, fiche, day, reason="1", group=None):
        return [(day, fiche, 10, reason, f"r{i}", group) for i in range(n)]

    events = frame(
        "date_abs date, fiche int, id_eco int, motif_abs string, remarque string, id_mat_grp int",
        *hit(3, 1, "2021-03-04"),  # full day
        *hit(5, 1, "2021-03-05"),  # more events than periods
        *hit(3, 1, "2021-03-08"),  # after the weekend: the run goes on
        *hit(3, 1, "2021-03-09"),  # no expected period: left out
        *hit(3, 1, "2021-03-10"),  # a school day was missed in between: new run
        *hit(1, 2, "2021-03-04", "1", 1),  # thirds of a day in two subjects
        *hit(2, 2, "2021-03-04", "2", 2),
        *hit(1, 2, "2021-03-05", "1", 1),  # part of a day
        *hit(1, 2, "2021-03-05", "3"),  # lateness
        *hit(1, 2, "2021-03-05", "8"),  # unknown reason
    )
    reasons = absences.absence_reasons(
        frame(
            "id_eco int, motif_abs string, descr string, cpt_abs int",
            (10, "1", "Maladie", 1), (10, "2", "Voyage", 4), (10, "3", "Retard", 3), (10, "4", "Rien", None),
        )
    )
    assert rows(reasons, "motif_abs", "category_abs", "is_absence") == [("1", "Absence", 1), ("2", None, 0)]
    subjects = frame("id_eco int, id_mat_grp int, mat string", (10, 1, "FRA"), (10, 2, "MAT"))
    return absences.absences_daily(events, subjects, reasons, pupils, calendar, terms, PARAMS)


def test_daily(daily):
    got = rows(
        daily, "fiche", "date_abs", "code_matiere", "event_kind", "prct_observed_periods_over_expected",
        "prct_observed_daily_over_expected", "etape",
    )
    third = pytest.approx(100 / 3)
    assert got == [
        (1, "2021-03-04", "-", "Journée complète", 100.0, 100.0, "2"),
        (1, "2021-03-05", "-", "Journée complète", 100.0, 100.0, "2"),
        (1, "2021-03-08", "-", "Journée complète", 100.0, 100.0, None),
        (1, "2021-03-10", "-", "Journée complète", 100.0, 100.0, None),
        (2, "2021-03-04", "FRA", "Journée complète", third, 100.0, "2"),
        (2, "2021-03-04", "FRA", "Journée complète", third, 100.0, "9"),
        (2, "2021-03-04", "MAT", "Journée complète", pytest.approx(200 / 3), 100.0, "2"),
        (2, "2021-03-04", "MAT", "Journée complète", pytest.approx(200 / 3), 100.0, "9"),
        (2, "2021-03-05", "FRA", "Périodes", third, third, "2"),
        (2, "2021-03-05", "FRA", "Périodes", third, third, "9"),
    ]
    first = daily.filter("fiche = 2 AND date_abs = '2021-03-04' AND code_matiere = 'MAT'").first()
    assert (first.groupe, first.jour_semaine, first.school_year, first.is_absence, first.event_description) == (
        "-", "jeudi", 2020, 0, "Voyage",
    )


def test_sequences_pass_weekends_and_break_on_school_days(daily, calendar):
    runs = absences.absence_sequences(daily.filter("fiche = 1"), calendar, PARAMS)
    assert rows(runs, "absence_sequence_id", "event_start_date", "event_end_date", "events_sequence_length") == [
        (0, "2021-03-04", "2021-03-08", 3), (1, "2021-03-10", "2021-03-10", 1),
    ]
    assert duplicate_keys(runs, ["school_year", "fiche", "id_eco", "absence_sequence_id", "event_kind"]).isEmpty()


@pytest.fixture
def students(frame, pupils, terms):
    years = frame("id_eco int, annee int, eco string", (10, 2020, "001"))
    spans = frame("annee int, date_deb date, date_fin date", (2020, "2020-07-01", "2021-06-30"))
    return absences.daily_students(pupils, years, spans, terms, PARAMS)


def test_daily_students(students):
    assert rows(students, "groupe", "etape", "date_evenement", "n_students_daily") == [
        ("-", 1, "2020-10-05", 1), ("-", 1, "2021-02-01", 0), ("-", 2, "2020-10-05", 1), ("-", 2, "2021-02-01", 0),
        ("101", 1, "2020-08-30", 1), ("101", 1, "2021-06-30", 0), ("101", 2, "2020-08-30", 1), ("101", 2, "2021-06-30", 0),
    ]


def test_grid_padding_and_metrics(frame, daily, calendar, students):
    start = frame(
        "id_eco int, date_evenement date, grille string, jour_cycle string, per_01 int, per_02 int, per_20 int",
        (10, "2020-08-30", "A", "J", 1, 1, 1), (10, "2020-10-05", "A", "J", 1, 1, 1), (10, "2021-02-01", "A", "J", 1, 1, 1),
    )
    days = with_all_periods(start).unionByName(calendar)
    grid = absences.daily_grid(days, daily, students, PARAMS)
    second = grid.filter("etape = 2 AND groupe = '101'")
    # Carried forward from August, and only inside the term.
    assert rows(second, "date_evenement", "n_students_daily", "n_subjects") == [
        ("2021-02-01", 1, 1), ("2021-03-04", 1, 1), ("2021-03-05", 1, 1), ("2021-03-06", 1, 1), ("2021-03-07", 1, 1),
    ]
    padded = absences.padding(grid, daily)
    keys = ["id_eco", "date_evenement", "groupe", "event_kind", "code_matiere", "etape", "grille"]
    assert duplicate_keys(padded, keys).isEmpty()
    assert padded.filter("groupe = '-'").select("code_matiere").distinct().count() == 2
    schools = frame(
        "id_eco int, eco string, annee int, annee_scolaire string, school_friendly_name string",
        (10, "001", 2020, "2020-2021", "École A"),
    )
    metrics = absences.daily_metrics(grid, daily, schools, PARAMS)
    got = rows(
        metrics.filter("groupe = '101' AND date_evenement > '2021-02-01' AND event_kind = 'Journée complète'"),
        "date_evenement", "etape_friendly", "n_events", "n_students_daily", "absence_rate",
    )
    assert got == [("2021-03-04", "étape : 2", 1, 1, 1.0), ("2021-03-05", "étape : 2", 1, 1, 1.0)]
    zero = metrics.filter("groupe = '101' AND date_evenement = '2021-02-01'")
    assert {r.absence_rate for r in zero.collect()} == {0.0}

    report = absence_reports.daily_rate_report(metrics)
    assert duplicate_keys(report, ["filter_key", "jour_semaine", "date_evenement"]).isEmpty()
    assert report.filter("absence_rate NOT BETWEEN 0 AND 1").isEmpty()
    assert absence_reports.absence_filters_report(metrics, schools).filter("eco IS NULL").count() > 0
    assert duplicate_keys(absence_reports.term_rate_report(metrics), ["filter_key", "etape_friendly"]).isEmpty()
    kinds = absence_reports.kind_distribution_report(daily, grid, schools, PARAMS)
    assert duplicate_keys(kinds, ["filter_key", "date_evenement", "event_description"]).isEmpty()
    # Every filter that a report uses is offered by the slicer table. (Pupil 2 has left by
    # then: their days have nobody enrolled and so no rate.)
    filters = absence_reports.absence_filters_report(metrics, schools)
    present = absence_reports.kind_distribution_report(daily.filter("fiche = 1"), grid, schools, PARAMS)
    assert present.count() > 0 and present.join(filters, "filter_key", "left_anti").isEmpty()


def test_recency(frame):
    events = frame("date_abs date, fiche int, id_eco int, motif_abs string, remarque string, id_mat_grp int",
                   ("2019-10-01", 1, 9, "1", None, 1), ("2018-10-01", 1, 8, "1", None, 1))
    years = frame("id_eco int, annee int, eco string", (9, 2019, "1"), (8, 2018, "1"))
    assert rows(absences.absence_events(events, years, PARAMS), "id_eco") == [(9,)]


def test_long_absence_bands(frame, pupils):
    runs = frame(
        "school_year int, fiche int, id_eco int, event_kind string, last_event_description string, last_remarque string, "
        "absence_sequence_id int, event_start_date date, event_end_date date, events_sequence_length int, etape string, etape_description string, seq_etape int",
        *[(y, 1, 10, "k", "d", None, i, "2021-01-01", "2021-01-02", n, "1", None, 1) for i, (y, n) in
          enumerate([(2020, 9), (2020, 10), (2019, 29), (2019, 30), (2018, 5)])],
    )
    people = frame("fiche int, nom string, pnom string, code_perm string", (1, "Roy", None, "R"))
    schools = frame("id_eco int, eco string, annee int, annee_scolaire string, school_friendly_name string", (10, "1", 2020, "x", "A"))
    got = absence_reports.long_absence_report(runs, people, pupils, schools, PARAMS)
    assert rows(got, "events_sequence_length", "events_sequence_interval", "full_name") == [
        (9, "Moins de 10 jours", "Roy "), (10, "entre 10 et 19 jours", "Roy "),
        (29, "entre 20 et 29 jours", "Roy "), (30, "plus de 30 jours", "Roy "),
    ]
