"""Kaplan-Meier estimation by age and the forecast of exits from age cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardroll.functions import clamp, product_over, ratio, surrogate_key


def survival_curve(
    exits: DataFrame, censored: DataFrame, age: str, low: int, high: int
) -> DataFrame:
    """Survival by age from ``low`` to ``high``.

    Exits outside the range are clipped into it; censored rows outside it are left out.
    An age nobody reaches has null rates and leaves the curve where it was.

    Both inputs are counted by age first. The windows without a partition run over those
    ``high - low + 1`` rows only.
    """
    events = exits.groupBy(clamp(age, low, high).cast("int").alias("age")).agg(
        F.count(F.lit(1)).alias("n_events")
    )
    losses = (
        censored.filter(F.col(age).between(low, high))
        .groupBy(F.col(age).cast("int").alias("age"))
        .agg(F.count(F.lit(1)).alias("n_censored"))
    )
    ages = exits.sparkSession.range(low, high + 1, 1, 1).select(F.col("id").cast("int").alias("age"))
    counts = (
        ages.join(events, "age", "left")
        .join(losses, "age", "left")
        .na.fill(0, ["n_events", "n_censored"])
    )
    from_here = Window.orderBy("age").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    upto = Window.orderBy("age").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    leaving = F.col("n_events") + F.col("n_censored")
    return (
        counts.withColumn("n_survivors", F.sum(leaving).over(from_here))
        .withColumn("instantaneous_death_rate", ratio("n_events", "n_survivors"))
        .withColumn("survival_rate", product_over(1 - F.col("instantaneous_death_rate"), upto))
    )


def forecast_exits(
    cohorts: DataFrame, curve: DataFrame, group: str, size: str = "n_employees", horizon: int = 5
) -> DataFrame:
    """Exits per group and horizon 0..``horizon``, from cohorts of one age and group.

    Each cohort is aged by the horizon, the survival product gives its cumulated exits
    (rounded), and the difference to the horizon before gives that year's. Ages off the
    curve drop out. A cohort has at most ``horizon + 1`` rows.
    """
    steps = F.explode(F.array(*[F.lit(step) for step in range(horizon + 1)]))
    aged = (
        cohorts.withColumn("cohort_id", surrogate_key("age", group))
        .withColumn("forecast_horizon", steps)
        .withColumn("age", F.col("age") + F.col("forecast_horizon"))
        .join(curve.select("age", "instantaneous_death_rate"), "age")
    )
    by_step = Window.partitionBy("cohort_id").orderBy("forecast_horizon")
    upto = by_step.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staying = product_over(1 - F.col("instantaneous_death_rate"), upto)
    gone = F.round(F.col(size) - F.col(size) * staying, 0)
    return (
        aged.withColumn("_gone", gone)
        .withColumn("_exits", F.col("_gone") - F.lag("_gone", 1, 0.0).over(by_step))
        .groupBy("forecast_horizon", group)
        .agg(F.sum("_exits").alias("n_exits"))
    )
