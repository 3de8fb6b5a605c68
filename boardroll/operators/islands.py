"""Gaps-and-islands: runs of consecutive positions and merged intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardroll.functions import weekdays_between


def island_ids(
    df: DataFrame, keys: Sequence[str], position: str, step: int = 1, name: str = "island_id"
) -> DataFrame:
    """Number the runs of each key, from 0, where positions rise by at most ``step``.

    Equal positions share a run. Expects a key to hold few rows per position (a calendar
    grain); collapse repeats first where it may not.
    """
    ordered = Window.partitionBy(*keys).orderBy(position)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    jump = (F.col(position) - F.lag(position).over(ordered) > step).cast("int")
    return (
        df.withColumn("_jump", F.coalesce(jump, F.lit(0)))
        .withColumn(name, F.sum("_jump").over(upto))
        .drop("_jump")
    )


def merge_intervals(
    df: DataFrame, keys: Sequence[str], start: str, end: str, max_gap: int = 1
) -> DataFrame:
    """Merge a key's intervals that follow each other within ``max_gap`` weekdays.

    An interval continues the one just before it, by start. Intervals that share a start
    are first collapsed to the longest, with map-side combining, which bounds the window
    of a key by the number of calendar days. Returns keys, start, end and ``island_id``,
    which counts from 1.
    """
    by_start = df.groupBy(*keys, start).agg(F.max(end).alias(end))
    ordered = Window.partitionBy(*keys).orderBy(start)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    follows = weekdays_between(F.lag(end).over(ordered), F.col(start)) <= max_gap
    return (
        by_start.withColumn("_new", F.when(follows, 0).otherwise(1))
        .withColumn("island_id", F.sum("_new").over(upto))
        .groupBy(*keys, "island_id")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
    )
