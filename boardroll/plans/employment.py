"""Employment: merged history, main jobs, yearly and current activity, seniority."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from boardroll.functions import concat_blank, school_year, school_year_start, weekdays_between
from boardroll.operators import (
    changes_to_intervals,
    clip_interval,
    expand_years,
    latest,
    merge_intervals,
    overlap_join,
    resolve_flag,
)
from boardroll.params import Params

PAID_WITHIN_DAYS = 14
MAX_GAP_WEEKDAYS = 1


def job_class_names(job_classes: DataFrame) -> DataFrame:
    """Job classes as 'code - (description)'."""
    return job_classes.select(
        F.col("corp_empl").alias("code_job"),
        concat_blank("corp_empl", F.lit(" - ("), "descr", F.lit(")")).alias("code_job_name"),
    )


def activity_history(jobs: DataFrame, params: Params) -> DataFrame:
    """Employment intervals, with those of equal attributes merged when they follow on."""
    attributes = ["matr", "ref_empl", "corp_empl", "etat", "lieu_trav", "stat_eng"]
    merged = merge_intervals(
        jobs.select(*attributes, "date_eff", "date_fin"),
        attributes,
        "date_eff",
        "date_fin",
        MAX_GAP_WEEKDAYS,
    )
    as_of = F.lit(params.as_of)
    ended = F.when(F.col("date_fin") > as_of, as_of).otherwise(F.col("date_fin"))
    return merged.select(
        "matr",
        school_year("date_eff", params.reference_month).alias("school_year"),
        "ref_empl",
        "corp_empl",
        F.col("etat").alias("etat_empl"),
        "stat_eng",
        "lieu_trav",
        "date_eff",
        ended.alias("date_fin"),
    )


def main_job_history(log: DataFrame, params: Params) -> DataFrame:
    """Main job of each employee over time, from the log of changes."""
    spans = changes_to_intervals(
        log, "matr", "date_eff", "ref_empl", "date_creat", F.lit(params.as_of)
    )
    return spans.select(
        school_year("valid_from", params.reference_month).alias("school_year"),
        "matr",
        F.col("ref_empl").alias("main_job"),
        "valid_from",
        "valid_until",
    )


def main_job_yearly(history: DataFrame, params: Params) -> DataFrame:
    """Last main job of each employee and school year."""
    years = expand_years(history, "valid_from", "valid_until", params.reference_month)
    return latest(years, ["matr", "school_year"], F.col("valid_from").desc()).select(
        "matr", "school_year", "main_job"
    )


def activity_yearly(
    history: DataFrame,
    statuses: DataFrame,
    main_jobs: DataFrame,
    current_jobs: DataFrame,
    params: Params,
) -> DataFrame:
    """Active jobs of each employee and school year, with the main one flagged.

    The main job is the logged one, else the only job, else the one marked as current,
    else the highest reference.
    """
    active = statuses.filter("etat_actif = 1").select("school_year", "etat_empl")
    years = expand_years(
        history.join(active, ["school_year", "etat_empl"]),
        "date_eff",
        "date_fin",
        params.reference_month,
    )
    job = ["matr", "school_year", "ref_empl"]
    jobs = latest(
        years, job, F.col("date_eff").desc(), F.col("date_fin").desc(), "corp_empl", "etat_empl",
        "lieu_trav", "stat_eng",
    )
    logged = main_jobs.select(
        "matr", "school_year", F.col("main_job").alias("ref_empl"), F.lit(1).alias("logged")
    )
    current = (
        current_jobs.filter("ind_empl_princ = 1")
        .select("matr", "ref_empl", F.lit(1).alias("current"))
        .distinct()
    )
    flagged = resolve_flag(
        jobs.join(logged, job, "left").join(current, ["matr", "ref_empl"], "left"),
        ["matr", "school_year"],
        "ref_empl",
        known=F.col("logged"),
        preferred=F.col("current"),
        name="is_main_job",
    )
    return flagged.select(
        *job, "corp_empl", "etat_empl", "lieu_trav", "stat_eng", "is_main_job"
    )


def activity_current(yearly: DataFrame, employees: DataFrame, params: Params) -> DataFrame:
    """Main job of the employees who were paid in the last two weeks."""
    since = F.date_sub(F.lit(params.as_of), PAID_WITHIN_DAYS)
    paid = employees.filter(F.col("last_pay_date") > since).select("matr")
    return (
        yearly.filter((F.col("school_year") == params.current_year) & (F.col("is_main_job") == 1))
        .join(paid, "matr")
        .select("matr", "corp_empl", "etat_empl", "lieu_trav", "stat_eng")
    )


def _running(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def seniority(
    history: DataFrame,
    statuses: DataFrame,
    engagements: DataFrame,
    main_jobs: DataFrame,
    job_groups: DataFrame,
    params: Params,
) -> DataFrame:
    """Days of experience, running over each unbroken stretch of regular main jobs.

    A job and a main-job span meet when they share a day. Years are the ones a stretch
    really touches, and a school year ends the day before the next one starts.
    """
    pivot = params.reference_month
    active = statuses.filter("etat_actif = 1").select("school_year", "etat_empl")
    regular = engagements.filter("is_reg = 1").select("school_year", "stat_eng")
    category = job_groups.select(F.col("job_group").alias("corp_empl"), "job_group_category")
    jobs = (
        history.join(active, ["school_year", "etat_empl"])
        .join(regular, ["school_year", "stat_eng"])
        .join(category, "corp_empl")
        .select("matr", "ref_empl", "job_group_category", "date_eff", "date_fin")
    )
    mains = main_jobs.select(
        "matr", F.col("main_job").alias("ref_empl"), "valid_from", "valid_until"
    )
    met = overlap_join(
        jobs,
        mains,
        ["matr", "ref_empl"],
        ("date_eff", "date_fin"),
        ("valid_from", "valid_until"),
    )
    starts, ends = clip_interval(
        F.col("date_eff"), F.col("date_fin"), F.col("valid_from"), F.col("valid_until")
    )
    held = met.select("matr", "job_group_category", starts.alias("start"), ends.alias("end"))
    # A person's intervals were merged above, so the calendar bounds these windows; they
    # share one partitioning, and with it one shuffle.
    person = Window.partitionBy("matr", "job_group_category").orderBy("start", "end")
    follows = weekdays_between(F.lag("end").over(person), "start") <= MAX_GAP_WEEKDAYS
    stretches = held.withColumn("breaks", F.when(follows, 0).otherwise(1)).withColumn(
        "stretch", F.sum("breaks").over(_running(person))
    )
    first = school_year_start("school_year", pivot)
    last = F.date_sub(school_year_start(F.col("school_year") + 1, pivot), 1)
    starts, ends = clip_interval(F.col("start"), F.col("end"), first, last)
    boxed = expand_years(stretches, "start", "end", pivot).select(
        "matr", "job_group_category", "stretch", "school_year", starts.alias("start"), ends.alias("end")
    )
    stretch = Window.partitionBy("matr", "job_group_category", "stretch").orderBy("start", "end")
    days = F.datediff("end", "start")
    return boxed.select(
        "school_year",
        "matr",
        "job_group_category",
        F.sum(days).over(_running(stretch)).alias("running_experience"),
        F.col("end").alias("valid_until"),
    )
