"""Pro-rata allocation of a line's hours over its account splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardroll.functions import ratio


def allocate(
    df: DataFrame,
    line: Sequence[str],
    quantity: str,
    part: str,
    total: str,
    keep_zero: Column,
    name: str = "allocated",
) -> DataFrame:
    """Share ``quantity`` of each line over its parts, in proportion ``part / total``.

    A zero part gets nothing, unless ``keep_zero`` holds: then the quantity is shared
    equally over the line's kept zero parts whose total is zero too. A part equal to the
    total, or a zero total, takes the whole quantity.

    The kept zero parts of a line are counted in a window over the line, whose rows are read
    once; a line with a null among its columns has none.
    """
    rows = df.withColumn("_keep", F.coalesce(keep_zero, F.lit(False)))
    is_zero = F.col("_keep") & (F.col(part) == 0) & (F.col(total) == 0)
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in line])
    number = F.count_if(is_zero).over(Window.partitionBy(*line))
    rest = [c for c in rows.columns if c not in line]
    counted = rows.select(*line, *rest, F.when(known & (number > 0), number).alias("_n_zero"))
    # Amounts are compared as they are but divided as doubles, whose scale is not fixed.
    whole, share = F.col(quantity).cast("double"), F.col(part).cast("double")
    given = (
        F.when((F.col(part) == 0) & F.col("_keep"), ratio(whole, F.col("_n_zero")))
        .when(F.col(part) == 0, F.lit(0.0))
        .when((F.col(total) == F.col(part)) | (F.col(total) == 0), whole)
        .otherwise(whole * ratio(share, F.col(total).cast("double")))
    )
    return counted.withColumn(name, given).drop("_keep", "_n_zero")
