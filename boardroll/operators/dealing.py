"""Dealing rows out so finely that what a task holds does not grow with the cluster's idle share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

PARTS = 96
LANE = "_lane"
_LANES = 2  # per shuffle partition: a task holds the sorts of a whole chain of joins


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by the keys to ``PARTS`` partitions, or the session's number if that is higher.

    Adaptive execution merges the partitions of its own shuffles until there is one per core, so a
    task's sorts and hash maps grow with the input; a named number of partitions stays. The same
    keys on both sides of a join, or a part of a grouping's keys, need no other shuffle.
    """
    return df.repartition(_parts(df), *keys)


def _parts(df: DataFrame) -> int:
    return max(PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _lanes(df: DataFrame) -> int:
    return max(PARTS, _LANES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def laned(df: DataFrame, *keys: str, otherwise: Sequence[str] = ()) -> DataFrame:
    """Rows dealt once for a chain of joins and groupings: by ``_lane``, a partition's number that follows from the keys.

    Tables laned by the same keys meet in place wherever ``_lane`` is among the columns they are joined or
    grouped by, and so do lookups given to every lane (``in_lanes``); partitioning by part of the
    keys would do for groupings only. Rows whose first key is null are spread by the columns
    ``otherwise``, if any. What ``unlaned`` has given for the same keys is not dealt again.
    """
    dealing = (keys, tuple(otherwise))
    before, rows = getattr(df, "_laned", (None, None))
    if before == dealing:
        return rows
    number = F.xxhash64(*keys)
    if otherwise:
        number = F.when(F.col(keys[0]).isNull(), F.xxhash64(*otherwise)).otherwise(number)
    lane = F.pmod(number, F.lit(_lanes(df))).cast("int")
    return df.withColumn(LANE, lane).repartitionById(_lanes(df), F.col(LANE))


def unlaned(rows: DataFrame, *keys: str, otherwise: Sequence[str] = ()) -> DataFrame:
    """Rows laned by the keys, without their lane; ``laned`` finds them as they lie."""
    table = rows.drop(LANE)
    table._laned = ((keys, tuple(otherwise)), rows)
    return table


def in_lanes(codes: DataFrame) -> DataFrame:
    """A small table, whole in every lane."""
    lanes = _lanes(codes)
    copies = codes.withColumn(LANE, F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    return copies.repartitionById(lanes, F.col(LANE))


def grouped(df: DataFrame, *keys: str) -> GroupedData:
    """Rows grouped by the keys: in place, with ``_lane`` as one more key, where they are laned by some of the keys."""
    (by, otherwise), rows = getattr(df, "_laned", (((), ()), None))
    if rows is None or not {*by, *otherwise} <= {*keys}:
        return df.groupBy(*keys)
    return rows.groupBy(*keys, LANE)


def join_codes(df: DataFrame, codes: DataFrame, column: str, *spread: str, how: str = "inner") -> DataFrame:
    """Join a large table to a small one on a code of few values, ``column`` on both sides.

    Where the codes are not broadcast, a join by the code alone gathers and sorts all rows of a code
    in one task. Here the rows of a code are spread over ``PARTS`` groups by the hash of the columns
    ``spread``, and every code is given to each group, so a row still meets each of its codes once.
    Laned rows (``laned``) stay where they are: their lanes are the groups.
    """
    if LANE in df.columns:
        return df.join(in_lanes(codes), [column, LANE], how)
    group = F.pmod(F.xxhash64(*spread), F.lit(PARTS)).cast("int")
    copied = codes.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return df.withColumn("_group", group).join(copied, [column, "_group"], how).drop("_group")
