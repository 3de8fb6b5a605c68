"""Pick the main row of each group by an ordered list of rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_flag(
    df: DataFrame,
    keys: Sequence[str],
    ref: str,
    known: Column,
    preferred: Column,
    name: str = "is_main",
) -> DataFrame:
    """Flag (0/1) the main rows of each group; the first rule that applies decides.

    1. rows for which ``known`` is 1; 2. the only ``ref`` of the group; 3. rows for which
    ``preferred`` is 1; 4. the highest ``ref``.

    All four rules read one aggregate per group, which is combined before the shuffle and
    joined back, so a hot group is never gathered in one window.
    """
    rows = df.withColumns(
        {"_known": F.coalesce(known, F.lit(0)), "_preferred": F.coalesce(preferred, F.lit(0))}
    )
    facts = {
        "_any_known": F.max("_known"),
        "_any_preferred": F.max("_preferred"),
        "_low": F.min(ref),
        "_high": F.max(ref),
    }
    groups = rows.groupBy(*keys).agg(*[agg.alias(fact) for fact, agg in facts.items()])
    judged = rows.join(groups, list(keys))
    flag = (
        F.when(F.col("_any_known") == 1, F.col("_known"))
        .when(F.col("_low") == F.col("_high"), 1)
        .when(F.col("_any_preferred") == 1, F.col("_preferred"))
        .otherwise((F.col(ref) == F.col("_high")).cast("int"))
    )
    return judged.withColumn(name, flag).drop("_known", "_preferred", *facts)
