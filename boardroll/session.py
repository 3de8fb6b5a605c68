"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "boardroll", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with adaptive execution on.

    No join in the library is hinted: adaptive execution broadcasts a side only once its
    measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and
    otherwise keeps the sort-merge join, splitting skewed partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
