"""Numeric helpers: ratios, caps, bands, running products and paid hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient that is null, not an error, when the denominator is zero."""
    return F.try_divide(_col(numerator), _col(denominator))


def cap(value: ColumnLike, limit: float) -> Column:
    """Upper bound that leaves nulls null (``least`` would return the bound)."""
    value = _col(value)
    return F.when(value > limit, F.lit(limit)).otherwise(value)


def clamp(value: ColumnLike, low: float, high: float) -> Column:
    value = _col(value)
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def band(value: ColumnLike, uppers: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open band a value falls in.

    ``uppers`` are exclusive upper edges in rising order; the last label takes the rest.
    A null value has a null label.
    """
    if len(labels) != len(uppers) + 1:
        raise ValueError("one more label than edges is needed")
    value = _col(value)
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, name in zip(uppers, labels):
        label = label.when(value < upper, F.lit(name))
    return label.otherwise(F.lit(labels[-1]))


def product_over(factor: ColumnLike, window: WindowSpec) -> Column:
    """Running product of non-negative factors, with zeros giving zero.

    A null factor leaves the product unchanged.
    """
    factor = _col(factor)
    logs = F.when(factor > 0, F.ln(factor))
    product = F.exp(F.coalesce(F.sum(logs).over(window), F.lit(0.0)))
    return F.when(F.min(factor).over(window) == 0, F.lit(0.0)).otherwise(product)


# How each pay mode turns paid units into hours.
DAILY_MODES = ("1", "5", "J")
HOURLY_MODES = ("H", "L", "2")
MINUTE_MODES = ("M", "G", "E", "6")
YEARLY_MODE_DIVISORS = {"P": 1000.0, "F": 720.0, "D": 800.0}
PART_DAY_MODES = {"3": 1 / 2, "4": 3 / 4}


def paid_hours(
    mode: ColumnLike, units: ColumnLike, hours_per_day: ColumnLike, hours_per_year: ColumnLike
) -> Column:
    """Hours paid for ``units`` of a pay mode; null for a mode that is not known."""
    mode, units = _col(mode), _col(units).cast("double")
    per_day, per_year = _col(hours_per_day), _col(hours_per_year)
    hours = (
        F.when(mode.isin(*DAILY_MODES), units * per_day)
        .when(mode.isin(*HOURLY_MODES), units)
        .when(mode.isin(*MINUTE_MODES), units / 60)
    )
    for code, divisor in YEARLY_MODE_DIVISORS.items():
        hours = hours.when(mode == code, units * per_year / divisor)
    for code, share in PART_DAY_MODES.items():
        hours = hours.when(mode == code, units * per_day * share)
    return hours
