"""Readers of upstream databases: Parquet folders, catalog tables, JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession


def parquet_tables(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    """Tables laid out as ``root/<table>.parquet``."""
    return lambda table: spark.read.parquet(f"{root}/{table}.parquet")


def saved_tables(spark: SparkSession, database: str) -> Callable[[str], DataFrame]:
    """Tables of a Spark catalog database."""
    return lambda table: spark.read.table(f"{database}.{table}")


def jdbc_tables(
    spark: SparkSession,
    url: str,
    schema: str = "dbo",
    properties: Mapping[str, str] | None = None,
    split: Mapping[str, tuple[str, int, int, int]] | None = None,
) -> Callable[[str], DataFrame]:
    """Tables of a relational database.

    ``split`` gives, per table, a numeric column with its bounds and the number of
    parallel reads; a table without an entry is read by a single connection.
    """

    def read(table: str) -> DataFrame:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"{schema}.{table}")
        for key, value in (properties or {}).items():
            reader = reader.option(key, value)
        if split and table in split:
            column, low, high, parts = split[table]
            reader = (
                reader.option("partitionColumn", column)
                .option("lowerBound", low)
                .option("upperBound", high)
                .option("numPartitions", parts)
            )
        return reader.load()

    return read
