"""Code lookups in a table that holds several code domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decode(
    df: DataFrame,
    codes: DataFrame,
    column: str,
    domain: str,
    name: str,
    code: str = "code",
    label: str = "cf_descr",
    domain_column: str = "nom_table",
) -> DataFrame:
    """Add the label of ``column``, looked up among the codes of one domain.

    The domain filter reaches the scan of the code table; a code without a label, or a
    null, gives null.
    """
    chosen = codes.filter(F.col(domain_column) == domain).select(
        F.col(code).alias("_code"), F.col(label).alias(name)
    )
    return df.join(chosen, F.col(column) == F.col("_code"), "left").drop("_code")


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """Rows for which ``column NOT IN (listed)`` is true in SQL's three-valued logic.

    A null in the list leaves no row, and a null ``column`` passes only an empty list.
    Both are read from one small aggregate of the list; the values themselves take a plain
    anti join, which needs no broadcast, unlike the null-aware join of a literal NOT IN.
    """
    value = F.col(listed_column)
    facts = listed.agg(
        F.struct(F.count(F.lit(1)).alias("all"), F.count_if(value.isNull()).alias("nulls"))
    ).scalar()
    passes = (facts["all"] == 0) | ((facts["nulls"] == 0) & F.col(column).isNotNull())
    keys = listed.select(value.alias("_listed")).distinct()
    return df.join(keys, F.col(column) == F.col("_listed"), "left_anti").filter(passes)
