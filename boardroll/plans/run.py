"""A run: build the wanted tables once each, lay them out, check them, show them, stamp the report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardroll.params import Params
from boardroll.plans.board import Board
from boardroll.plans.checks import CHECKS, check_table
from boardroll.sources import Snapshots, stamp


class ChecksFailed(Exception):
    """Declared checks that do not hold, as (table, check, failures)."""


def run_report(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    params: Params,
    root: str,
    report: str,
    tables: Sequence[str],
    ended_at: datetime,
) -> DataFrame:
    """Write ``tables`` under ``root/report``, check them, show them, stamp the report; their checks.

    A table that several others need is written once and read back by all of them, whether
    it is wanted itself or not. The checks read what was written; only if every check
    holds do all tables of the report become current, at once, and the stamp is set. Otherwise,
    or if the run breaks off, readers of the report still see its last good tables;
    ``ChecksFailed`` tells which checks do not hold, and ``_checks`` keeps them all.
    """
    place = Snapshots(spark, f"{root}/{report}")
    board = Board(inputs, params, place.stage)
    found = None
    for name in tables:
        written = board.shared(name)
        if name in CHECKS:
            checked = check_table(name, written).select(F.lit(name).alias("table"), "check_name", "n_failures")
            found = checked if found is None else found.unionByName(checked)
    if found is None:
        found = spark.createDataFrame([], "table string, check_name string, n_failures long")
    found = place.refresh(found, "_checks")
    failed = [tuple(row) for row in found.filter("n_failures > 0").collect()]  # one row per check
    if failed:
        raise ChecksFailed(failed)
    place.commit()
    stamp(spark, root, report, ended_at)
    return found
