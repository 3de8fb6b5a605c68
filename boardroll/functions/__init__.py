"""Column helpers; every one is a built-in expression, none is a UDF."""

from boardroll.functions.dates import (
    age_on,
    day_of_year,
    french_weekday,
    school_year,
    school_year_start,
    weekdays_between,
    year_boundaries,
    yyyymmdd,
)
from boardroll.functions.numbers import band, cap, clamp, paid_hours, product_over, ratio
from boardroll.functions.text import (
    NULL_MARKER,
    concat_blank,
    dash_if_blank,
    insert_at,
    is_blank,
    surrogate_key,
)

__all__ = [
    "NULL_MARKER",
    "age_on",
    "band",
    "cap",
    "clamp",
    "concat_blank",
    "dash_if_blank",
    "day_of_year",
    "french_weekday",
    "insert_at",
    "is_blank",
    "paid_hours",
    "product_over",
    "ratio",
    "school_year",
    "school_year_start",
    "surrogate_key",
    "weekdays_between",
    "year_boundaries",
    "yyyymmdd",
]
