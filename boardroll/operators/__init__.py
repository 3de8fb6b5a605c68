"""Reusable DataFrame building blocks.

Shared rules: keys are never null; only samples of a fixed size are collected to the driver;
no join is hinted (adaptive execution broadcasts by measured size); a per-key window is used
only where the group is bounded by the calendar or was pre-aggregated, otherwise hot keys
are cut into pieces into which the scan's state is carried (``scan``).
"""

from boardroll.operators.allocation import allocate
from boardroll.operators.cubes import UNKNOWN, labelled_cube, row_cube
from boardroll.operators.dealing import dealt, in_lanes, join_codes, laned, unlaned
from boardroll.operators.filling import dense_days, fill_missing
from boardroll.operators.flags import resolve_flag
from boardroll.operators.headcount import headcount
from boardroll.operators.intervals import (
    Buckets,
    as_of_join,
    changes_to_intervals,
    clashing_intervals,
    clip_interval,
    expand_years,
    overlap_join,
    point_in_interval_join,
)
from boardroll.operators.islands import island_ids, merge_intervals
from boardroll.operators.latest import latest
from boardroll.operators.lookup import decode, not_in
from boardroll.operators.quality import (
    duplicate_keys,
    null_rows,
    outside_range,
    quality_report,
    unexpected_values,
)
from boardroll.operators.scan import carry_forward, previous_value, running_max, running_sum
from boardroll.operators.survival import forecast_exits, survival_curve

__all__ = [
    "Buckets",
    "UNKNOWN",
    "allocate",
    "as_of_join",
    "carry_forward",
    "changes_to_intervals",
    "clashing_intervals",
    "clip_interval",
    "dealt",
    "decode",
    "dense_days",
    "duplicate_keys",
    "expand_years",
    "fill_missing",
    "forecast_exits",
    "headcount",
    "in_lanes",
    "island_ids",
    "join_codes",
    "labelled_cube",
    "laned",
    "latest",
    "merge_intervals",
    "not_in",
    "null_rows",
    "outside_range",
    "overlap_join",
    "point_in_interval_join",
    "previous_value",
    "quality_report",
    "resolve_flag",
    "row_cube",
    "running_max",
    "running_sum",
    "survival_curve",
    "unexpected_values",
    "unlaned",
]
