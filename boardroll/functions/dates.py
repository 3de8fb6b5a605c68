"""Calendar arithmetic on school years, weekdays and ages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Weekday names shown in the reports, Sunday first.
FRENCH_WEEKDAYS = ("dimanche", "lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi")

_A_MONDAY = date(1900, 1, 1)


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def school_year(day: ColumnLike, pivot_month: int = 7) -> Column:
    """Starting year of the school year that holds ``day``.

    Months before ``pivot_month`` belong to the year before.
    """
    day = _col(day)
    return F.year(day) - (F.month(day) < pivot_month).cast("int")


def school_year_start(year: ColumnLike, pivot_month: int = 7) -> Column:
    """First day of a school year."""
    return F.make_date(_col(year), F.lit(pivot_month), F.lit(1))


def day_of_year(year: ColumnLike, month: int, day: int) -> Column:
    """A fixed calendar day (such as 30 September) of a given year."""
    return F.make_date(_col(year), F.lit(month), F.lit(day))


def year_boundaries(start: ColumnLike, end: ColumnLike) -> Column:
    """Number of 1 January boundaries crossed, not the number of full years."""
    return F.year(_col(end)) - F.year(_col(start))


def age_on(birth: ColumnLike, day: ColumnLike) -> Column:
    """Age as whole 365.25-day years."""
    return F.floor(F.datediff(_col(day), _col(birth)) / F.lit(365.25)).cast("int")


def yyyymmdd(text: ColumnLike) -> Column:
    """Date held as eight digits of text; null when it is not a date."""
    return F.try_to_date(_col(text), "yyyyMMdd")


def french_weekday(day: ColumnLike) -> Column:
    names = F.array(*[F.lit(name) for name in FRENCH_WEEKDAYS])
    return F.element_at(names, F.dayofweek(_col(day)))


def _weekdays_up_to(day: Column) -> Column:
    """Monday-to-Friday days from a fixed Monday up to and including ``day``."""
    offset = F.datediff(day, F.lit(_A_MONDAY))
    return F.floor(offset / 7) * 5 + F.least(F.pmod(offset, F.lit(7)) + 1, F.lit(5))


def weekdays_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Monday-to-Friday days after ``start`` up to and including ``end``.

    Friday to the next Monday is 1. Null when either end is null.
    """
    start, end = _col(start), _col(end)
    span = _weekdays_up_to(end) - _weekdays_up_to(start)
    return F.when(start.isNotNull() & end.isNotNull(), span.cast("int"))
