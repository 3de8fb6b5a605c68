"""Explicit run parameters.

No job reads a clock or a site configuration file: the run date, the current school year
and every code list are fields here, so the same inputs always give the same result.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Params:
    as_of: date
    """Run date; replaces "today" everywhere."""
    current_year: int
    """Starting year of the running school year."""
    reference_month: int = 7
    """First month of a school year for HR tables (1-12)."""

    # Recency windows, in school years.
    years_of_absences: int = 10
    years_of_students: int = 10
    years_of_adults: int = 5
    years_in_report: int = 5
    years_of_retirements: int = 10

    # Absence jobs.
    max_periods: int = 20
    primary_group: str = "grp_rep"
    secondary_group: str = "dist"
    terms: tuple[str, ...] = ("1", "2", "3")

    # Adult-education jobs.
    success_reasons: tuple[int, ...] = (22, 12, 4, 2)
    excluded_services: tuple[str, ...] = ()
    still_enrolled_reason: str = "10"

    # Pay jobs.
    pay_from: date = date(2020, 7, 1)

    def __post_init__(self) -> None:
        if not 1 <= self.reference_month <= 12:
            raise ValueError("reference_month must be between 1 and 12")
        for name in (self.primary_group, self.secondary_group):
            if name not in ("grp_rep", "dist", "class"):
                raise ValueError(f"unknown group column {name!r}")
