"""Daily headcount from entry and exit dates, without expanding to one row per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardroll.operators.dealing import dealt


def headcount(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    member: str,
    day: str = "day",
    name: str = "headcount",
    lowest: Sequence[str] = (),
    highest: Sequence[str] = (),
) -> DataFrame:
    """Members present after each day on which someone enters or leaves.

    A member counts once per (keys, day, direction); the exit day itself is not counted.
    ``lowest`` and ``highest`` columns come out as the min and max over the rows that
    enter that day or, when nobody enters, over those that leave.

    Stays are dealt by key and member, which serves the counting of a member's moves too; moves are
    reduced to one row per (keys, day) before the running sum, so its window holds at most
    one row per calendar day.
    """
    move = F.explode(
        F.array(
            F.struct(F.col(start).alias("day"), F.lit(1).alias("sign")),
            F.struct(F.col(end).alias("day"), F.lit(-1).alias("sign")),
        )
    )
    stays = dealt(df.select(*keys, member, start, end, *lowest, *highest), *keys, member)
    moves = stays.select(*keys, member, *lowest, *highest, move.alias("_move")).select(
        *keys,
        member,
        *lowest,
        *highest,
        F.col("_move.day").alias(day),
        F.col("_move.sign").alias("_sign"),
    )
    extremes = [(c, F.min) for c in lowest] + [(c, F.max) for c in highest]
    members = moves.groupBy(*keys, day, "_sign", member).agg(
        F.count(F.lit(1)).alias("_rows"), *[agg(c).alias(c) for c, agg in extremes]
    )
    entering = F.col("_sign") == 1
    daily = members.groupBy(*keys, day).agg(
        F.sum("_sign").alias("_delta"),
        *[
            F.coalesce(agg(F.when(entering, F.col(c))), agg(c)).alias(c)
            for c, agg in extremes
        ],
    )
    upto = (
        Window.partitionBy(*keys)
        .orderBy(day)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumn(name, F.sum("_delta").over(upto)).drop("_delta")
