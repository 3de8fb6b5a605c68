"""Absenteeism reports: rates, distributions, filters and long absences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardroll.functions import band, concat_blank, ratio, surrogate_key
from boardroll.operators import UNKNOWN, labelled_cube, latest
from boardroll.params import Params
from boardroll.plans.absences import (
    NO_GROUP,
    NO_SUBJECT,
    TERM_PREFIX,
    UNKNOWN_TERM,
    group_of,
    term_code,
)

# Labels of total rows and of run-length bands.
ALL_SCHOOLS, ALL = "Tout le CSS", "Tout"
TOTALS = {"school_friendly_name": ALL_SCHOOLS, "groupe": ALL, "etape_friendly": ALL}
RUN_EDGES = (10, 20, 30)
RUN_LABELS = (
    "Moins de 10 jours",
    "entre 10 et 19 jours",
    "entre 20 et 29 jours",
    "plus de 30 jours",
)


def filter_key() -> Column:
    """Key that links the slicer table to the reports."""
    return surrogate_key(
        "annee", "school_friendly_name", "etape_friendly", "event_kind", "groupe"
    ).alias("filter_key")


def _rates(cells: DataFrame, fixed: list[str], dims: list[str], name: str) -> DataFrame:
    """Rate weighted by pupils for every subset of ``dims``, totals labelled."""
    cube = labelled_cube(
        cells,
        fixed,
        {dim: TOTALS[dim] for dim in dims},
        {
            "weighted": F.sum(F.col("absence_rate") * F.col("n_students_daily")),
            "weight": F.sum("n_students_daily"),
        },
    )
    return cube.select(*fixed, *dims, ratio("weighted", "weight").alias(name))


def daily_rate_report(metrics: DataFrame) -> DataFrame:
    """Daily rate per filter, with board, school and weekday means beside it.

    Each mean is a small cube of its own over the day's cells, combined before its shuffle
    and joined back, so nothing is gathered in a window. A mean over the report's rows,
    totals included, counts every cell equally often; it therefore equals the mean over
    the cells themselves, which is what is computed.
    """
    grain = ["annee", "school_friendly_name", "groupe", "etape_friendly"]
    per_day = metrics.groupBy(*grain, "date_evenement", "jour_semaine", "event_kind").agg(
        F.max("n_events").alias("n_events"),
        F.max("n_students_daily").alias("n_students_daily"),
        F.max("absence_rate").alias("absence_rate"),
    )
    cube = labelled_cube(
        per_day,
        ["annee", "date_evenement", "jour_semaine", "event_kind"],
        TOTALS,
        {
            "n_events": F.sum("n_events"),
            "n_students_daily": F.sum("n_students_daily"),
            "weighted": F.sum(F.col("absence_rate") * F.col("n_students_daily")),
        },
    )
    day, weekday = ["annee", "date_evenement", "event_kind"], ["annee", "jour_semaine", "event_kind"]
    of_school = ["school_friendly_name", "etape_friendly"]
    board = _rates(per_day, day, ["etape_friendly"], "absence_rate_css")
    school = _rates(per_day, ["annee", "event_kind"], of_school, "avg_absence_rate_school")
    # The school's mean travels with the weekday's, so that the cube is shuffled once for both.
    habits = _rates(per_day, weekday, list(TOTALS), "avg_absence_rate_jour").join(
        school, ["annee", "event_kind", *of_school], "left"
    )
    joined = cube.join(habits, [*weekday, *TOTALS], "left").join(board, [*day, "etape_friendly"], "left")
    return joined.select(
        filter_key(),
        "jour_semaine",
        "date_evenement",
        "n_events",
        ratio("weighted", "n_students_daily").alias("absence_rate"),
        "n_students_daily",
        "absence_rate_css",
        "avg_absence_rate_school",
        "avg_absence_rate_jour",
    )


def term_rate_report(metrics: DataFrame) -> DataFrame:
    """Rate per term and filter, beside the board's rate and the school's yearly rate."""
    term, filters = ["annee", "etape_friendly", "event_kind"], ["school_friendly_name", "groupe"]
    rates = _rates(metrics, term, filters, "avg_absence_rate_etape")
    board = _rates(metrics, term, [], "avg_absence_rate_etape_css")
    yearly = _rates(metrics, ["annee", "event_kind"], filters, "avg_absence_rate_school")
    return (
        rates.join(board, term, "left")
        .join(yearly, ["annee", "event_kind", *filters], "left")
        .select(
            filter_key(),
            "etape_friendly",
            "avg_absence_rate_etape",
            "avg_absence_rate_etape_css",
            "avg_absence_rate_school",
        )
    )


def _counted_on_grid(
    daily: DataFrame, grid: DataFrame, schools: DataFrame, by: str, params: Params
) -> DataFrame:
    """Absences counted by ``by`` on the school days of the grid, with school names."""
    cell = ["id_eco", "date_evenement", "groupe", "grille", "etape"]
    counts = (
        daily.filter(F.col("school_year") >= params.current_year - params.years_in_report)
        .filter("is_aggregate_kind = 0")
        .withColumn("etape", term_code(params))
        .withColumnRenamed("date_abs", "date_evenement")
        .groupBy(*cell, "event_kind", by)
        .agg(F.count("fiche").alias("n_events"))
    )
    days = grid.filter("is_school_day = 1").select(*cell, "jour_semaine")
    named = schools.select("id_eco", "annee", "school_friendly_name")
    return (
        counts.join(days, cell)
        .join(named, "id_eco", "left")
        .withColumn("etape_friendly", concat_blank(F.lit(TERM_PREFIX), "etape"))
    )


def kind_distribution_report(
    daily: DataFrame, grid: DataFrame, schools: DataFrame, params: Params
) -> DataFrame:
    """Number of absences per day and reason, for every filter."""
    counted = _counted_on_grid(daily, grid, schools, "event_description", params)
    cube = labelled_cube(
        counted,
        ["annee", "date_evenement", "jour_semaine", "event_kind", "event_description"],
        TOTALS,
        {"n_events": F.sum("n_events")},
    )
    return cube.select(
        filter_key(), "date_evenement", "jour_semaine", "event_description", "n_events"
    )


def subject_distribution_report(
    daily: DataFrame,
    grid: DataFrame,
    schools: DataFrame,
    subject_names: DataFrame,
    params: Params,
) -> DataFrame:
    """Number of absences per day and subject, for every filter.

    A subject bears, in all schools, the description that the school with the highest id
    of the year gives it.
    """
    described = latest(
        subject_names.join(schools.select("id_eco", "annee"), "id_eco"),
        ["annee", "mat"],
        F.col("id_eco").desc(),
        F.col("description_abreg"),
    ).select("annee", F.col("mat").alias("code_matiere"), "description_abreg")
    counted = _counted_on_grid(
        daily.filter(F.col("code_matiere") != NO_SUBJECT), grid, schools, "code_matiere", params
    ).join(described, ["annee", "code_matiere"])
    cube = labelled_cube(
        counted,
        ["annee", "date_evenement", "jour_semaine", "event_kind", "code_matiere", "description_abreg"],
        TOTALS,
        {"n_events": F.sum("n_events")},
    )
    return cube.select(
        filter_key(),
        "date_evenement",
        "jour_semaine",
        "code_matiere",
        "description_abreg",
        "n_events",
    )


def absence_filters_report(metrics: DataFrame, schools: DataFrame) -> DataFrame:
    """Slicer table: every filter that the absence reports can be cut by."""
    cube = labelled_cube(
        metrics,
        ["annee", "event_kind"],
        {"eco": None, "groupe": ALL, "etape_friendly": ALL},
        {"n_rows": F.count(F.lit(1))},
    )
    named = schools.select("eco", "annee", "school_friendly_name")
    return (
        cube.join(named, ["eco", "annee"], "left")
        .withColumn(
            "school_friendly_name",
            F.when(F.col("eco").isNull(), F.lit(ALL_SCHOOLS)).otherwise(
                F.coalesce("school_friendly_name", F.lit(UNKNOWN))
            ),
        )
        .select(
            "annee",
            "school_friendly_name",
            "etape_friendly",
            "event_kind",
            "groupe",
            filter_key(),
            "eco",
        )
    )


def long_absence_report(
    sequences: DataFrame,
    people: DataFrame,
    pupils: DataFrame,
    schools: DataFrame,
    params: Params,
) -> DataFrame:
    """Runs of absence of this year and the last, with the pupil and a length band."""
    recent = sequences.filter(
        F.col("school_year").between(params.current_year - 1, params.current_year)
    )
    names = people.select("fiche", F.concat_ws(" ", F.coalesce("nom", F.lit("")), F.coalesce("pnom", F.lit(""))).alias("full_name"))
    groups = pupils.select(
        "fiche", "id_eco", F.coalesce(group_of(params), F.lit(NO_GROUP)).alias("groupe")
    )
    named = schools.select("id_eco", "eco", "annee_scolaire", "school_friendly_name")
    return (
        recent.join(names, "fiche")
        .join(groups, ["fiche", "id_eco"])
        .join(named, "id_eco", "left")
        .select(
            "school_friendly_name",
            "annee_scolaire",
            "fiche",
            "full_name",
            "groupe",
            F.coalesce("etape_description", F.lit(UNKNOWN_TERM)).alias("etape_description"),
            "event_start_date",
            "event_end_date",
            band("events_sequence_length", RUN_EDGES, RUN_LABELS).alias(
                "events_sequence_interval"
            ),
            "events_sequence_length",
            "event_kind",
            "last_event_description",
            "last_remarque",
            "id_eco",
            "eco",
        )
    )
