"""Dense calendars and imputed values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dense_days(df: DataFrame, first: Column, last: Column, name: str = "day") -> DataFrame:
    """Repeat each row for every day from ``first`` to ``last``.

    The bounds are columns or scalar subqueries (``DataFrame.scalar()``), so the calendar
    is generated beside each row and no cross join is planned.
    """
    return df.withColumn(name, F.explode(F.sequence(first, last)))


def fill_missing(
    grid: DataFrame, facts: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Every cell of ``grid``, with the default where ``facts`` has no row or a null."""
    joined = grid.join(facts, list(keys), "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )
