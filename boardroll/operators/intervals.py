"""Interval operators: joins on time, year expansion, change logs and clipping."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardroll.functions import school_year
from boardroll.operators.dealing import dealt
from boardroll.operators.scan import CHUNK_ROWS, carry_forward, running_max

_EPOCH = date(1970, 1, 1)


@dataclass(frozen=True)
class Buckets:
    """Time buckets that spread a key's rows over several join groups.

    Buckets are numbered over all days. Only days after ``last`` share its bucket, so that
    an open end such as year 9999 costs no more than one at ``last``; every day still has
    exactly one bucket.
    """

    days: int = 366
    last: date = date(2100, 1, 1)

    def of(self, day: Column) -> Column:
        inside = F.least(day, F.lit(self.last))
        number = F.floor(F.datediff(inside, F.lit(_EPOCH)) / self.days).cast("int")
        return F.when(day.isNotNull(), number)

    def touched(self, start: Column, end: Column) -> Column:
        """One array entry per bucket an interval touches; null for an empty interval."""
        return F.when(start <= end, F.sequence(self.of(start), self.of(end)))


def point_in_interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    how: str = "inner",
    buckets: Buckets = Buckets(),
    fine: bool = False,
) -> DataFrame:
    """Join each point to the intervals of its key that hold it, both ends included.

    Points and intervals also meet on a time bucket, so a hot key is spread over its
    buckets and a point is compared only with intervals near it. A point has exactly one
    bucket, so left joins stay exact. ``start`` and ``end`` are not returned. ``fine`` deals both
    sides to many partitions (``dealt``), for two large sides without hot keys.
    """
    left = points.withColumn("_bucket", buckets.of(F.col(at)))
    right = (
        intervals.withColumnsRenamed({start: "_start", end: "_end"})
        .withColumn("_bucket", F.explode(buckets.touched(F.col("_start"), F.col("_end"))))
        .withColumnsRenamed({key: f"_k_{key}" for key in [*keys, "_bucket"]})
    )
    if fine:
        left, right = dealt(left, *keys, "_bucket"), dealt(right, *[f"_k_{key}" for key in [*keys, "_bucket"]])
    on = [F.col(key) == F.col(f"_k_{key}") for key in [*keys, "_bucket"]]
    on.append(F.col(at).between(F.col("_start"), F.col("_end")))
    return left.join(right, on, how).drop(
        "_bucket", "_start", "_end", *[f"_k_{key}" for key in [*keys, "_bucket"]]
    )


def as_of_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    how: str = "inner",
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """Join each point to the interval of its key that holds it, where intervals of a key are disjoint.

    No interval is copied: points and starts of intervals are merged by (key, time), and each
    point takes the interval that started last, if it has not ended. The merge is an ordered
    scan, so a hot key is cut into pieces and the interval open at a cut is carried into the
    next piece. Both ends belong to an interval; one without days is ignored.

    Two intervals of a key that share a day break the rule; ``clashing_intervals`` finds them,
    and ``point_in_interval_join`` joins them. Points with a null key or time match nothing.
    ``start`` and ``end`` are not returned.
    """
    held = [c for c in intervals.columns if c not in {*keys, start, end}]
    opened = intervals.where(F.col(start) <= F.col(end)).select(
        *keys,
        F.col(start).alias("_at"),
        F.lit(0).alias("_side"),
        F.struct(F.col(end).alias("_end"), *held).alias("_open"),
    )
    asked = points.select(
        *keys,
        F.col(at).cast(intervals.schema[start].dataType).alias("_at"),
        F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in points.columns if c not in keys]).alias("_point"),
    )
    merged = opened.unionByName(asked, allowMissingColumns=True)
    carried = carry_forward(merged, keys, ["_at", "_side"], "_open", chunk_rows=chunk_rows).where("_side = 1")
    known = [F.col(k).isNotNull() for k in keys]
    holds = reduce(Column.__and__, known, F.col("_at") <= F.col("_open._end"))
    if how == "inner":
        carried = carried.where(holds)
    elif how != "left":
        raise ValueError(f"as-of joins are inner or left, not {how}")
    found = carried.withColumn("_open", F.when(holds, F.col("_open")))
    own = [F.col(c) if c in keys else F.col(f"_point.{c}").alias(c) for c in points.columns]
    return found.select(*own, *[F.col(f"_open.{c}").alias(c) for c in held])


def clashing_intervals(
    intervals: DataFrame, keys: Sequence[str], start: str, end: str, chunk_rows: int | None = CHUNK_ROWS
) -> DataFrame:
    """Intervals that share a day with an earlier one of their key, by (start, end)."""
    real = intervals.where(F.col(start) <= F.col(end))
    before = running_max(real, keys, [start, end], F.col(end), "_latest", include_current=False, chunk_rows=chunk_rows)
    return before.where(F.col("_latest") >= F.col(start)).drop("_latest")


_FINEST = 32  # days of the smallest cells; each level's cells are eight times as wide
_WIDTHS = tuple(_FINEST * 8**level for level in range(7))  # the widest is 22,000 years


def _cell(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / width).cast("int")


def _on_level(level: int, cell: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), cell.alias("cell"))


def _cells_of_span(start: Column, end: Column) -> Column:
    """The one or two cells that an interval touches on the level of its length; null without days."""
    days, cells = F.datediff(end, start) + 1, F.lit(None)
    for level, width in reversed([*enumerate(_WIDTHS)]):
        touched = [_on_level(level, _cell(day, width)) for day in (start, end)]
        cells = F.when(days <= width, F.array_distinct(F.array(*touched))).otherwise(cells)
    return F.when(start <= end, cells)


def _cells_of_day(day: Column) -> Column:
    """The cell of a day on every level."""
    return F.array(*[_on_level(level, _cell(day, width)) for level, width in enumerate(_WIDTHS)])


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
) -> DataFrame:
    """Pairs of the same key whose spans share at least one day, both ends included.

    Time is divided into cells on seven levels, eight times as wide on each. A span lies in the one or
    two cells it touches on the level as wide as itself, however long it is, and its first
    day asks the cell around it on every level: nine rows at most, also for a span without
    an end in sight. Two spans meet exactly where the first day of the later one asks
    the cells of the earlier (of equal first days, where the right one asks), so each pair
    comes out once, and both sides are read once. Columns other than the keys must have
    distinct names on the two sides; dates only.
    """
    (ls, le), (rs, re) = left_span, right_span

    def spread(df: DataFrame, start: str, end: str, lies: int) -> DataFrame:
        real = F.col(start) <= F.col(end)
        lying, asking = _cells_of_span(F.col(start), F.col(end)), _cells_of_day(F.col(start))
        both = F.array(
            F.struct(F.lit(lies).alias("side"), lying.alias("cells")),
            F.struct(F.lit(1 - lies).alias("side"), asking.alias("cells")),
        )
        rows = df.where(real).withColumn("_both", F.explode(both))
        return rows.select(*df.columns, F.col("_both.side").alias("_side"), F.explode("_both.cells").alias("_at")).select(
            *df.columns, "_side", F.col("_at.level").alias("_level"), F.col("_at.cell").alias("_cell")
        )

    met = spread(left, ls, le, 0).join(spread(right, rs, re, 1), [*keys, "_side", "_level", "_cell"])
    # Side 0: the left span lies there and the right one asks.
    right_asks = (F.col("_side") == 0) & F.col(rs).between(F.col(ls), F.col(le))
    left_asks = (F.col("_side") == 1) & (F.col(ls) > F.col(rs)) & (F.col(ls) <= F.col(re))
    return met.where(right_asks | left_asks).drop("_side", "_level", "_cell")


def clip_interval(
    start: Column, end: Column, lower: Column, upper: Column
) -> tuple[Column, Column]:
    """Part of ``[start, end]`` inside ``[lower, upper]``; a null bound does not cut."""
    return (
        F.when(lower > start, lower).otherwise(start),
        F.when(end > upper, upper).otherwise(end),
    )


def expand_years(
    df: DataFrame, start: str, end: str, pivot_month: int = 7, name: str = "school_year"
) -> DataFrame:
    """One row per school year from that of ``start`` to that of ``end``, both included.

    The years come from the row itself, so the fan-out is the length of the interval.
    """
    first, last = school_year(start, pivot_month), school_year(end, pivot_month)
    return df.withColumn(name, F.explode(F.when(first <= last, F.sequence(first, last))))


def changes_to_intervals(
    log: DataFrame,
    key: str,
    at: str,
    value: str,
    written: str,
    until: Column,
    start: str = "valid_from",
    end: str = "valid_until",
) -> DataFrame:
    """Turn a change log into validity intervals; ``end`` is the next change (excluded).

    Log rows of a key are read by ``at``, then ``written``. A day counts as a change when
    the value moves on it, and its last value holds. Only the first, last, lowest and
    highest value of each (key, day) are needed for that, so the log is reduced to one
    row per key and day before the window.
    """
    days = log.groupBy(key, at).agg(
        F.min_by(value, F.struct(written, value)).alias("_first"),
        F.max_by(value, F.struct(written, value)).alias(value),
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
    )
    by_day = Window.partitionBy(key).orderBy(at)
    moved = F.coalesce(F.lag(value).over(by_day) != F.col("_first"), F.lit(True))
    return (
        days.withColumn("_moved", moved | (F.col("_low") != F.col("_high")))
        .filter("_moved")
        .withColumn(end, F.coalesce(F.lead(at).over(by_day), until))
        .select(key, value, F.col(at).alias(start), end)
    )
