"""Tables that several steps of a run share: kept by Spark, or written to a named folder."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


class Kept:
    """Keeps shared tables in Spark's own storage, filled when a query first reads them.

    Nothing is written while a plan is built, and blocks lost with an executor are
    computed again. ``clear`` lets them go.
    """

    def __init__(self) -> None:
        self._tables: list[DataFrame] = []

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._tables.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self._tables[-1]

    def clear(self) -> None:
        while self._tables:
            self._tables.pop().unpersist()


class Staging:
    """Writes a run's shared tables under a folder of its own, which cuts their lineage.

    ``folder`` must be shared by all executors; it is ``spark.checkpoint.dir`` by default,
    and there is no other fallback.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        folder = folder or spark.conf.get(_SETTING, None)
        if not folder:
            raise ValueError(f"name a folder that all executors share, or set {_SETTING}")
        self._spark = spark
        self.run_folder = f"{folder.rstrip('/')}/boardroll/{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back: computed once, lineage cut, columns prunable.

        The files outlive the loss of any executor.
        """
        path = f"{self.run_folder}/{name}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete what this run has written."""
        jvm = self._spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.run_folder)
        path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
