"""Text helpers, including the surrogate key that links report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Fixed value: what a null part of a surrogate key is replaced with.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def concat_blank(*parts: ColumnLike) -> Column:
    """Concatenate, taking null as empty text; the result is never null."""
    return F.concat_ws("", *[_col(part).cast("string") for part in parts])


def is_blank(value: ColumnLike) -> Column:
    """True for null, empty and all-space text."""
    value = _col(value)
    return value.isNull() | (F.trim(value) == "")


def dash_if_blank(value: ColumnLike) -> Column:
    value = _col(value)
    return F.when(is_blank(value), F.lit("-")).otherwise(value)


def insert_at(value: ColumnLike, separator: str, *positions: int) -> Column:
    """Insert ``separator`` before each 1-based position of the text as it then stands.

    Null when a position lies beyond the end of the text.
    """
    value = _col(value)
    for position in positions:
        value = F.when(
            F.length(value) >= position,
            F.overlay(value, F.lit(separator), F.lit(position), F.lit(0)),
        )
    return value


def surrogate_key(*parts: ColumnLike) -> Column:
    """md5 of the parts joined by '-', with a marker in place of nulls."""
    texts = [F.coalesce(_col(part).cast("string"), F.lit(NULL_MARKER)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))
