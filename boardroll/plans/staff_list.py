"""The active-staff list report: its parameterised detail, slicer lists and head count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DETAIL = (
    "workplace_name", "matr", "legal_name", "job_class", "employment_status_name", "type",
    "email_address",
)
SLICERS = (
    "workplace_name", "job_class", "employment_status_name", "type", "is_current",
    "job_department",
)


def chosen(report: DataFrame, choices: Mapping[str, Sequence[object]]) -> DataFrame:
    """Rows whose slicer columns have one of the chosen values."""
    unknown = set(choices) - set(SLICERS)
    if unknown:
        raise ValueError(f"not a slicer: {', '.join(sorted(unknown))}")
    for column, values in choices.items():
        report = report.filter(F.col(column).isin(*values))
    return report


def staff_detail(
    report: DataFrame, choices: Mapping[str, Sequence[object]], search: str = ""
) -> DataFrame:
    """Chosen employees whose name holds the search text, in any case."""
    named = F.lower("legal_name").contains(search.lower())
    return chosen(report, choices).filter(named).select(*DETAIL)


def staff_count(report: DataFrame, choices: Mapping[str, Sequence[object]]) -> DataFrame:
    return chosen(report, choices).agg(F.count("matr").alias("nbr"))


def slicer_values(report: DataFrame, column: str) -> DataFrame:
    """Sorted values of one slicer."""
    if column not in SLICERS:
        raise ValueError(f"not a slicer: {column}")
    return report.select(column).distinct().orderBy(column)
