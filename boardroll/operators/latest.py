"""Top-1 per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """First row of each key in ``order`` (pass descending columns for the latest).

    Catalyst turns ``row_number() = 1`` into a group limit that runs before the shuffle,
    so a hot key sends one row per input task, not all of its rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
