"""Absenteeism: events, daily rates of absence, runs of absence and enrolled pupils."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardroll.functions import cap, concat_blank, french_weekday, ratio, school_year
from boardroll.operators import carry_forward, dealt, headcount, island_ids, point_in_interval_join
from boardroll.params import Params

# Labels and codes shown in the tables.
FULL_DAY, SOME_PERIODS = "Journée complète", "Périodes"
KINDS = (FULL_DAY, SOME_PERIODS)
UNKNOWN_REASON = "inconnue"
NO_SUBJECT = NO_GROUP = "-"
NO_GRID = "unknown"
TERM_PREFIX, UNKNOWN_TERM = "étape : ", "inconnue"
COUNTED_CATEGORIES, LATENESS = (1, 2), 3
SECONDARY_LEVEL = "4"
ABSENCE_PIVOT_MONTH = 7


def group_of(params: Params) -> Column:
    """Group a pupil is reported in; secondary pupils may use another column."""
    return F.when(
        F.col("ordre_ens") == SECONDARY_LEVEL, F.col(params.secondary_group)
    ).otherwise(F.col(params.primary_group))


def term_code(params: Params) -> Column:
    """Term as a number, 0 for a term that is not followed."""
    return F.when(F.col("etape").isin(*params.terms), F.col("etape").cast("int")).otherwise(0)


def absence_events(events: DataFrame, school_years: DataFrame, params: Params) -> DataFrame:
    """Absence events of the school years that are kept."""
    kept = school_years.filter(
        F.col("annee") >= params.current_year - params.years_of_absences
    ).select("id_eco")
    return events.select(
        "date_abs", "fiche", "id_eco", "motif_abs", "remarque", "id_mat_grp"
    ).join(kept, "id_eco")


def absence_reasons(reasons: DataFrame) -> DataFrame:
    """Reasons that count: categorised, and not a lateness."""
    counted = F.col("cpt_abs").isin(*COUNTED_CATEGORIES)
    return (
        reasons.filter(F.col("cpt_abs") != LATENESS)
        .select("id_eco", "motif_abs", "descr", "cpt_abs")
        .distinct()
        .select(
            "id_eco",
            "motif_abs",
            F.col("descr").alias("description_abs"),
            F.when(counted, F.lit("Absence")).alias("category_abs"),
            counted.cast("int").alias("is_absence"),
        )
    )


def expected_periods(calendar: DataFrame, params: Params) -> DataFrame:
    """Periods held on each working day of a school's grid; all period columns are needed."""
    periods = [f"per_{i:02d}" for i in range(1, params.max_periods + 1)]
    missing = [c for c in periods if c not in calendar.columns]
    if missing:
        raise ValueError(f"the calendar lacks the period columns {', '.join(missing)}")
    held = [F.bool_or(F.col(c).isNotNull()).cast("int") for c in periods]
    return (
        calendar.filter(F.col("jour_cycle").isNotNull())
        .groupBy("id_eco", F.col("date_evenement").alias("date_abs"), "grille")
        .agg(sum(held[1:], held[0]).alias("n_expected"))
    )


def absences_daily(
    events: DataFrame,
    subject_groups: DataFrame,
    reasons: DataFrame,
    pupils: DataFrame,
    calendar: DataFrame,
    terms: DataFrame,
    params: Params,
) -> DataFrame:
    """Share of the day's periods a pupil missed, by subject, with the term of the day.

    Events are counted per pupil, day and subject before any of the wider joins, so what
    follows is bounded by pupils x days x subjects however many events come in.
    """
    counted = (
        events.join(subject_groups.select("id_eco", "id_mat_grp", "mat"), ["id_eco", "id_mat_grp"], "left")
        .withColumn("code_matiere", F.coalesce("mat", F.lit(NO_SUBJECT)))
        .join(reasons, ["id_eco", "motif_abs"])
        .groupBy("date_abs", "fiche", "id_eco", "is_absence", "code_matiere")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.coalesce(F.min("description_abs"), F.lit(UNKNOWN_REASON)).alias("description"),
            F.min("remarque").alias("remarque"),
        )
    )
    placed = pupils.select(
        "fiche", "id_eco", "grille", F.coalesce(group_of(params), F.lit(NO_GROUP)).alias("groupe")
    )
    # The whole day is summed in periods and divided once, so that thirds of a day add up
    # to exactly 100 %. Rows dealt by pupil and school serve the join, the window and the grouping.
    same_day = Window.partitionBy("date_abs", "fiche", "id_eco")
    measured = (
        dealt(counted, "fiche", "id_eco")
        .join(dealt(placed, "fiche", "id_eco"), ["fiche", "id_eco"])
        .join(expected_periods(calendar, params), ["id_eco", "date_abs", "grille"])
        .filter("n_expected > 0")
        .withColumn("by_subject", F.col("n_events") * 100.0 / F.col("n_expected"))
        .withColumn("by_day", F.sum("n_events").over(same_day) * 100.0 / F.col("n_expected"))
        .withColumn(
            "event_kind",
            F.when(F.col("by_day") < 100, F.lit(SOME_PERIODS)).otherwise(F.lit(FULL_DAY)),
        )
    )
    by_subject = measured.groupBy(
        "date_abs", "fiche", "id_eco", "groupe", "code_matiere", "event_kind"
    ).agg(
        F.max("grille").alias("grille"),
        F.min(F.coalesce("is_absence", F.lit(1))).alias("is_absence"),
        F.min("description").alias("event_description"),
        F.min("remarque").alias("remarque"),
        cap(F.sum("by_subject"), 100.0).alias("prct_observed_periods_over_expected"),
        cap(F.sum("by_day"), 100.0).alias("prct_observed_daily_over_expected"),
    )
    spans = terms.select(
        "fiche", "id_eco", "etape", "etape_description", "seq_etape", "date_debut", "date_fin"
    )
    return point_in_interval_join(
        by_subject, spans, ["fiche", "id_eco"], "date_abs", "date_debut", "date_fin", how="left", fine=True
    ).select(
        school_year("date_abs", ABSENCE_PIVOT_MONTH).alias("school_year"),
        "date_abs",
        french_weekday("date_abs").alias("jour_semaine"),
        "fiche",
        "id_eco",
        "groupe",
        "code_matiere",
        "grille",
        "event_kind",
        F.lit(0).alias("is_aggregate_kind"),
        "is_absence",
        "event_description",
        "remarque",
        "prct_observed_periods_over_expected",
        "prct_observed_daily_over_expected",
        "etape",
        "etape_description",
        "seq_etape",
    )


def absence_sequences(daily: DataFrame, calendar: DataFrame, params: Params) -> DataFrame:
    """Runs of consecutive school days with an absence of one kind.

    School days are numbered per school, grid and year, so a weekend or a holiday does
    not break a run. The description is that of the run's last day.
    """
    numbering = Window.partitionBy("id_eco", "grille", "school_year").orderBy("date_evenement")
    school_days = (
        calendar.filter(F.col("jour_cycle").isNotNull())
        .filter(F.col("date_evenement") <= F.lit(params.as_of))
        .select(
            "id_eco",
            "grille",
            "date_evenement",
            school_year("date_evenement", ABSENCE_PIVOT_MONTH).alias("school_year"),
        )
        .withColumn("day_id", F.row_number().over(numbering))
        .select("id_eco", "grille", F.col("date_evenement").alias("date_abs"), "day_id")
    )
    run = ["school_year", "fiche", "id_eco", "event_kind"]
    numbered = island_ids(
        daily.join(school_days, ["id_eco", "grille", "date_abs"]),
        run,
        "day_id",
        name="absence_sequence_id",
    )
    last_day = F.max_by(
        F.struct("event_description", "remarque"), F.struct("day_id", "code_matiere")
    )
    return (
        numbered.groupBy(*run, "absence_sequence_id")
        .agg(
            last_day.alias("last"),
            F.min("date_abs").alias("event_start_date"),
            F.max("date_abs").alias("event_end_date"),
            (F.max("day_id") - F.min("day_id") + 1).alias("events_sequence_length"),
            F.min("etape").alias("etape"),
            F.min("etape_description").alias("etape_description"),
            F.min("seq_etape").alias("seq_etape"),
        )
        .select(
            *run,
            F.col("last.event_description").alias("last_event_description"),
            F.col("last.remarque").alias("last_remarque"),
            "absence_sequence_id",
            "event_start_date",
            "event_end_date",
            "events_sequence_length",
            "etape",
            "etape_description",
            "seq_etape",
        )
    )


def daily_students(
    pupils: DataFrame,
    school_years: DataFrame,
    year_spans: DataFrame,
    terms: DataFrame,
    params: Params,
) -> DataFrame:
    """Pupils enrolled per school, group, grid and term after each entry or exit day.

    A pupil is counted in every term their stay touches; a pupil without a followed term
    is not counted. A missing exit date is the end of the school year.
    """
    spans = year_spans.select("annee", F.col("date_fin").alias("year_end"))
    stays = (
        pupils.filter(F.col("date_debut") <= F.lit(params.as_of))
        .join(school_years.select("id_eco", "annee"), "id_eco")
        .join(spans, "annee")
        .select(
            "fiche",
            "id_eco",
            F.coalesce(group_of(params), F.lit(NO_GROUP)).alias("groupe"),
            F.coalesce("grille", F.lit(NO_GRID)).alias("grille"),
            F.col("date_debut").alias("enters"),
            F.coalesce("date_depart", "year_end").alias("leaves"),
        )
    )
    followed = terms.filter(F.col("etape").isin(*params.terms)).select(
        "fiche",
        "id_eco",
        F.col("etape").cast("int").alias("etape"),
        F.col("date_debut").alias("etape_date_debut"),
        F.col("date_fin").alias("etape_date_fin"),
    )
    opens, closes = F.col("etape_date_debut"), F.col("etape_date_fin")
    enters, leaves = F.col("enters"), F.col("leaves")
    touches = (
        enters.between(opens, closes)
        | leaves.between(opens, closes)
        | ((enters <= opens) & (leaves >= closes))
    )
    return headcount(
        stays.join(followed, ["fiche", "id_eco"]).filter(touches),
        ["id_eco", "groupe", "grille", "etape"],
        start="enters",
        end="leaves",
        member="fiche",
        day="date_evenement",
        name="n_students_daily",
        lowest=["etape_date_debut"],
        highest=["etape_date_fin"],
    )


def daily_grid(
    calendar: DataFrame, daily: DataFrame, students: DataFrame, params: Params
) -> DataFrame:
    """Last known headcount on every calendar day of each school, group, grid and term.

    The reference repeats this grid for each kind and subject before it fills the gaps.
    The headcount depends on neither, so the grid is filled first and ``n_subjects``
    keeps the number of repeats; ``padding`` expands it where a job wants the rows.
    """
    seen = daily.select("id_eco", "groupe", "code_matiere").distinct()
    subjects = seen.groupBy("id_eco", "groupe").agg(F.count(F.lit(1)).alias("n_subjects"))
    days = (
        calendar.filter(F.col("date_evenement") <= F.lit(params.as_of))
        .filter(F.year("date_evenement") >= params.current_year - params.years_in_report)
        .groupBy("id_eco", "grille", "date_evenement")
        .agg(F.max(F.col("jour_cycle").isNotNull().cast("int")).alias("is_school_day"))
    )
    cells = (
        students.groupBy("id_eco", "groupe", "grille", "etape")
        .agg(
            F.min("etape_date_debut").alias("etape_date_debut"),
            F.max("etape_date_fin").alias("etape_date_fin"),
        )
        .join(subjects, ["id_eco", "groupe"])
    )
    key = ["id_eco", "groupe", "grille", "etape"]
    known = students.select(*key, "date_evenement", "n_students_daily")
    grid = days.join(cells, ["id_eco", "grille"]).join(known, [*key, "date_evenement"], "left")
    return (
        carry_forward(grid, key, ["date_evenement"], "n_students_daily", chunk_rows=None)
        .filter(F.col("date_evenement").between(F.col("etape_date_debut"), F.col("etape_date_fin")))
        .withColumn("jour_semaine", french_weekday("date_evenement"))
    )


def _with_kinds(grid: DataFrame, daily: DataFrame) -> DataFrame:
    """Repeat the grid for each kind of absence that was observed at all.

    The kinds come as one small array (there are two), not as a join on a key that would
    have only two values.
    """
    observed = daily.filter(F.col("event_kind").isin(*KINDS)).agg(F.collect_set("event_kind"))
    return grid.withColumn("event_kind", F.explode(observed.scalar()))


def padding(grid: DataFrame, daily: DataFrame) -> DataFrame:
    """The grid repeated for each observed kind and each subject of the group."""
    subjects = daily.select("id_eco", "groupe", "code_matiere").distinct()
    return (
        _with_kinds(grid, daily)
        .join(subjects, ["id_eco", "groupe"])
        .select(
            "id_eco",
            "date_evenement",
            "jour_semaine",
            "groupe",
            "grille",
            "is_school_day",
            "event_kind",
            "code_matiere",
            "etape",
            "etape_date_debut",
            "etape_date_fin",
            "n_students_daily",
        )
    )


def daily_metrics(
    grid: DataFrame, daily: DataFrame, schools: DataFrame, params: Params
) -> DataFrame:
    """Absence rate per school day, with zero where nobody was absent.

    Counts are those over the padded rows, so they are repeated per subject of the group
    (``n_subjects``); the rate is not affected.
    """
    absent = daily.withColumn("etape", term_code(params)).withColumnRenamed(
        "date_abs", "date_evenement"
    )
    cell = ["id_eco", "date_evenement", "groupe", "etape", "event_kind"]
    by_grid = absent.groupBy(*cell, "grille").agg(F.count_distinct("fiche").alias("n_absent"))
    by_subject = absent.groupBy(*cell, "code_matiere").agg(
        F.count_distinct("fiche").alias("n_events_matiere")
    )
    repeated = F.col("n_subjects")
    totals = (
        _with_kinds(grid.filter("is_school_day = 1"), daily)
        .join(by_grid, [*cell, "grille"], "left")
        .groupBy(*cell, "jour_semaine")
        .agg(
            F.sum(F.coalesce("n_absent", F.lit(0)) * repeated).alias("n_events"),
            F.sum(F.col("n_students_daily") * repeated).alias("n_students_daily"),
        )
        .filter("n_students_daily > 0")
    )
    named = schools.select("id_eco", "eco", "annee", "school_friendly_name")
    term = F.when(F.col("etape") == 0, F.lit(UNKNOWN_TERM)).otherwise(F.col("etape").cast("string"))
    return (
        totals.join(by_subject, cell, "left")
        .join(named, "id_eco", "left")
        .select(
            "annee",
            "school_friendly_name",
            "date_evenement",
            "jour_semaine",
            "groupe",
            F.coalesce("code_matiere", F.lit(NO_SUBJECT)).alias("code_matiere"),
            concat_blank(F.lit(TERM_PREFIX), term).alias("etape_friendly"),
            "event_kind",
            "n_events",
            "n_events_matiere",
            "n_students_daily",
            cap(ratio("n_events", "n_students_daily"), 1.0).alias("absence_rate"),
            "id_eco",
            "eco",
        )
    )
