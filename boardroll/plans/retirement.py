"""Retirement: retirements, survival curve, forecast and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardroll import operators
from boardroll.functions import school_year, school_year_start, surrogate_key, year_boundaries
from boardroll.operators import latest
from boardroll.params import Params

# Age range of the curve and of the cohorts, horizon, label of unknowns.
CURVE_AGES = (50, 70)
COHORT_AGES = (45, 70)
LATEST_ENTRY_AGE = 60
HORIZON = 5
UNKNOWN = "Inconnu"
SLICERS = ("genre", "job_group_category", "lieu_trav", "stat_eng", "etat")


def retirements(history: DataFrame, statuses: DataFrame, employees: DataFrame) -> DataFrame:
    """Latest start of a retired status per employee, with the age reached that year."""
    retired = statuses.filter("empl_retr = 1").select("school_year", "etat_empl")
    last = latest(
        history.join(retired, ["school_year", "etat_empl"]),
        ["matr"],
        F.col("date_eff").desc(),
        "etat_empl",
        "corp_empl",
        "lieu_trav",
        "stat_eng",
    )
    births = employees.select("matr", "birth_date")
    return last.join(births, "matr", "left").select(
        "matr",
        F.col("etat_empl").alias("etat"),
        "corp_empl",
        "lieu_trav",
        "stat_eng",
        F.col("date_eff").alias("retirement_date"),
        year_boundaries("birth_date", "date_eff").alias("retirement_age"),
    )


def survival_curve(files: DataFrame, retired: DataFrame) -> DataFrame:
    """Chance of not being retired at each age.

    Employees who are not retired are censored at the age of their last pay. Those who
    were first hired late in life count neither as survivors nor as censored.
    """
    censored = (
        files.filter(year_boundaries("date_nais", "date_entr") < LATEST_ENTRY_AGE)
        .join(retired.select("matr"), "matr", "left_anti")
        .select(year_boundaries("date_nais", "date_dern_paie").alias("age"))
    )
    exits = retired.select(F.col("retirement_age").alias("age"))
    return operators.survival_curve(exits, censored, "age", *CURVE_AGES)


def _not_retired(current: DataFrame, retired: DataFrame) -> DataFrame:
    return operators.not_in(current, "matr", retired, "matr")


def _job_category(job_groups: DataFrame) -> DataFrame:
    return job_groups.select(F.col("job_group").alias("corp_empl"), "job_group_category")


def retirement_forecasts(
    current: DataFrame,
    retired: DataFrame,
    files: DataFrame,
    job_groups: DataFrame,
    curve: DataFrame,
    params: Params,
) -> DataFrame:
    """Retirements expected per job category in this and the next five school years."""
    start = date(params.current_year, params.reference_month, 1)
    cohorts = (
        _not_retired(current, retired)
        .join(files.select("matr", "date_nais"), "matr", "left")
        .join(_job_category(job_groups), "corp_empl", "left")
        .withColumn("age", year_boundaries("date_nais", F.lit(start)))
        .filter(F.col("age").between(*COHORT_AGES))
        .groupBy("age", "job_group_category")
        .agg(F.count("matr").alias("n_employees"))
    )
    exits = operators.forecast_exits(
        cohorts, curve, "job_group_category", "n_employees", HORIZON
    )
    steps = F.explode(F.array(*[F.lit(step) for step in range(HORIZON + 1)]))
    grid = (
        job_groups.select("job_group_category")
        .distinct()
        .withColumn("forecast_horizon", steps)
    )
    filled = operators.fill_missing(
        grid, exits, ["forecast_horizon", "job_group_category"], {"n_exits": 0.0}
    )
    year = F.lit(params.current_year) + F.col("forecast_horizon")
    return filled.select(
        school_year_start(year, params.reference_month).alias("school_year"),
        "job_group_category",
        F.col("n_exits").alias("n_retiring_employees"),
    )


def _known(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(UNKNOWN)).alias(name)


def active_age_report(
    current: DataFrame,
    retired: DataFrame,
    employees: DataFrame,
    job_groups: DataFrame,
    params: Params,
) -> DataFrame:
    """Number of employees still working, by age at the start of the school year."""
    start = date(params.current_year, params.reference_month, 1)
    rows = (
        _not_retired(current, retired)
        .join(employees.select("matr", "birth_date", "genre"), "matr", "left")
        .join(_job_category(job_groups), "corp_empl", "left")
        .withColumnRenamed("etat_empl", "etat")
        .select(
            "genre",
            *[_known(c) for c in SLICERS[1:]],
            year_boundaries("birth_date", F.lit(start)).alias("age"),
        )
    )
    return (
        rows.groupBy(*SLICERS, "age")
        .agg(F.count(F.lit(1)).alias("n_employees"))
        .withColumn("filter_key", surrogate_key(*SLICERS))
    )


def retirement_age_report(
    retired: DataFrame, job_groups: DataFrame, files: DataFrame, params: Params
) -> DataFrame:
    """Number of retirees of the last ten years, by age at retirement."""
    year = school_year("retirement_date", params.reference_month)
    rows = (
        retired.withColumn("year", year)
        .filter(F.col("year") >= params.current_year - params.years_of_retirements)
        .join(_job_category(job_groups), "corp_empl", "left")
        .join(files.select("matr", F.col("sexe").alias("genre")), "matr", "left")
        .select("genre", *[_known(c) for c in SLICERS[1:]], "year", "retirement_age")
    )
    return (
        rows.groupBy(*SLICERS, "year", "retirement_age")
        .agg(F.count(F.lit(1)).alias("n_retirees"))
        .select(
            *SLICERS,
            school_year_start("year", params.reference_month).alias("school_year"),
            (F.col("year") == params.current_year).cast("int").alias("is_current_year"),
            "retirement_age",
            "n_retirees",
            surrogate_key(*SLICERS).alias("filter_key"),
        )
    )


def observed_and_forecast_report(
    forecasts: DataFrame, retired: DataFrame, job_groups: DataFrame, params: Params
) -> DataFrame:
    """Past retirements per year and category, followed by the expected ones."""
    so_far = (
        Window.partitionBy("job_group_category")
        .orderBy("school_year")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    expected = forecasts.select(
        "school_year",
        "job_group_category",
        F.lit(None).cast("long").alias("observed_retiring_employes"),
        F.col("n_retiring_employees").alias("forecast_retiring_employees"),
        F.sum("n_retiring_employees").over(so_far).alias("running_forecast_retiring_employees"),
        F.lit(1).alias("is_forecast"),
    )
    year = school_year("retirement_date", params.reference_month)
    observed = (
        retired.withColumn("year", year)
        .filter(F.col("year") >= params.current_year - params.years_of_retirements)
        .join(_job_category(job_groups), "corp_empl", "left")
        .groupBy("year", "job_group_category")
        .agg(F.count(F.lit(1)).alias("observed_retiring_employes"))
        .select(
            school_year_start("year", params.reference_month).alias("school_year"),
            "job_group_category",
            "observed_retiring_employes",
            F.lit(None).cast("double").alias("forecast_retiring_employees"),
            F.lit(None).cast("double").alias("running_forecast_retiring_employees"),
            F.lit(0).alias("is_forecast"),
        )
    )
    return expected.unionByName(observed)


def survival_curve_report(curve: DataFrame) -> DataFrame:
    return curve.select("age", "instantaneous_death_rate", "survival_rate")


def retirement_filters_report(
    active: DataFrame,
    retired: DataFrame,
    statuses: DataFrame,
    engagements: DataFrame,
    workplaces: DataFrame,
) -> DataFrame:
    """Slicer table over both age reports, with the names valid today."""
    both = active.select(*SLICERS, "filter_key", F.lit("active").alias("filter_source")).unionByName(
        retired.select(*SLICERS, "filter_key", F.lit("retirement").alias("filter_source"))
    )
    filters = both.groupBy(*SLICERS, "filter_key").agg(
        F.max("filter_source").alias("filter_source")
    )
    status = statuses.filter("is_current = 1").select(
        F.col("etat_empl").alias("etat"), F.col("etat_empl").alias("employment_status_name")
    )
    engagement = engagements.filter("is_current = 1").select(
        "stat_eng", F.col("stat_eng").alias("engagement_status_name")
    )
    places = workplaces.select(F.col("workplace").alias("lieu_trav"), "workplace_name")
    return (
        filters.join(status, "etat", "left")
        .join(engagement, "stat_eng", "left")
        .join(places, "lieu_trav", "left")
        .select(
            "genre",
            "employment_status_name",
            "engagement_status_name",
            "workplace_name",
            "job_group_category",
            "filter_key",
            "filter_source",
        )
    )
