"""Written tables: layout by year and key, snapshots with one pointer, freshness stamps."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from boardroll.sources import files


@dataclass(frozen=True)
class Layout:
    """How a table is laid out.

    Folders by ``partition``, files sorted by ``cluster``, a bloom filter on each column of
    ``lookup``. A catalog table is bucketed by ``bucket``, if given.
    """

    partition: tuple[str, ...] = ()
    cluster: tuple[str, ...] = ()
    lookup: tuple[str, ...] = ()
    bucket: tuple[str, ...] = ()


# The columns each table is looked up by.
LAYOUTS = {
    "absences_daily": Layout(("school_year",), ("id_eco", "fiche"), ("fiche",)),
    "absence_sequences": Layout(("school_year",), ("id_eco", "fiche"), ("fiche",)),
    "absence_reasons": Layout((), ("id_eco", "motif_abs")),
    "daily_students": Layout((), ("id_eco", "grille", "date_evenement")),
    "daily_grid": Layout((), ("id_eco", "grille", "date_evenement")),
    "daily_metrics": Layout(("annee",), ("school_friendly_name", "date_evenement")),
    "adult_students": Layout((), ("code_perm",)),
    "adult_enrolments": Layout(("annee",), ("code_perm", "fiche", "freq"), ("fiche",)),
    "activity_yearly": Layout(("school_year",), ("matr", "ref_empl"), ("matr",), ("matr",)),
    "main_job_yearly": Layout(("school_year",), ("matr",), ("matr", "main_job"), ("matr",)),
    "activity_current": Layout((), ("matr",), (), ("matr",)),
    "retirements": Layout((), ("matr", "corp_empl", "lieu_trav", "stat_eng"), ("matr",)),
    "retirement_forecasts": Layout((), ("school_year",)),
    "retirement_curve": Layout((), ("age",)),
    "teacher_qualifications": Layout((), ("matr", "workplace", "etat_empl"), ("matr",)),
    "qualification_report": Layout((), ("matricule", "lieu_principal")),
    "paid_hours_by_account": Layout(("annee",), ("matr", "no_cheq"), ("matr",)),
}


def layout_of(name: str) -> Layout:
    return LAYOUTS.get(name, Layout())


def with_filters(writer: DataFrameWriter, layout: Layout) -> DataFrameWriter:
    """Folders by year, and bloom filters, by which a lookup skips row groups without its value."""
    for column in layout.lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer.partitionBy(*layout.partition) if layout.partition else writer


def write_files(df: DataFrame, path: str, layout: Layout) -> None:
    """Write a table's files into a new folder.

    Rows are range-partitioned on the whole layout before the write: each folder gets few
    files, each file a narrow key range (so min/max statistics skip it), and a hot year or
    key is split over several tasks because the cluster columns take part in the ranges.
    Finding the ranges reads the rows once more, so they are kept on the executors' disks
    meanwhile: the plan itself runs once.
    """
    ordered = [*layout.partition, *layout.cluster]
    if not ordered:
        with_filters(df.write, layout).parquet(path)
        return
    kept = df.persist(StorageLevel.DISK_ONLY)
    try:
        ranged = kept.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
        with_filters(ranged.write, layout).parquet(path)
    finally:
        kept.unpersist()


class Snapshots:
    """Tables below a folder, of which each refresh is a version of its own.

    ``stage`` writes a version that nobody reads yet. ``commit`` makes staged versions
    current by replacing one small file that names every table's version, so readers go
    from the old tables to the new ones at once, and a job that fails on the way leaves
    the old ones as they were. A reader that has started keeps its version until ``vacuum``
    deletes those that are no longer current. One writer at a time.
    """

    _POINTER = "_current.json"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._root = spark, root.rstrip("/")
        self._staged: dict[str, dict] = {}

    def _current(self) -> dict[str, dict]:
        text = files.read_text(self._spark, f"{self._root}/{self._POINTER}")
        return json.loads(text) if text else {}

    def _open(self, name: str, version: dict) -> DataFrame:
        schema = StructType.fromJson(version["schema"])
        table = self._spark.read.schema(schema).parquet(f"{self._root}/{name}/{version['folder']}")
        return table.select(*schema.names)  # columns of folders come last otherwise

    def stage(self, df: DataFrame, name: str, layout: Layout | None = None) -> DataFrame:
        """Write a version of the table and read it back, which also cuts the lineage."""
        version = {"folder": uuid.uuid4().hex, "schema": json.loads(df.schema.json())}
        write_files(df, f"{self._root}/{name}/{version['folder']}", layout or layout_of(name))
        self._staged[name] = version
        return self._open(name, version)

    def commit(self, names: Sequence[str] | None = None) -> None:
        """Make the staged versions current, of all tables or of those named, at once."""
        chosen = list(self._staged if names is None else names)
        if unknown := [n for n in chosen if n not in self._staged]:
            raise KeyError(f"nothing staged for {', '.join(unknown)}")
        current = self._current() | {n: self._staged[n] for n in chosen}
        files.replace_text(self._spark, f"{self._root}/{self._POINTER}", json.dumps(current))
        for name in chosen:
            del self._staged[name]

    def refresh(self, df: DataFrame, name: str, layout: Layout | None = None) -> DataFrame:
        """Replace one table."""
        table = self.stage(df, name, layout)
        self.commit([name])
        return table

    def tables(self) -> list[str]:
        return sorted(self._current())

    def read(self, name: str) -> DataFrame:
        """The table's current version."""
        current = self._current()
        if name not in current:
            raise KeyError(f"{self._root} has no table {name}")
        return self._open(name, current[name])

    def vacuum(self) -> int:
        """Delete all versions that are neither current nor staged here; how many they were."""
        held = {(n, v["folder"]) for n, v in [*self._current().items(), *self._staged.items()]}
        gone = [
            (name, folder)
            for name in files.folders(self._spark, self._root)
            if not name.startswith("_freshness")
            for folder in files.folders(self._spark, f"{self._root}/{name}")
            if (name, folder) not in held
        ]
        for name, folder in gone:
            files.delete(self._spark, f"{self._root}/{name}/{folder}")
        return len(gone)


def write_table(df: DataFrame, root: str, name: str, layout: Layout | None = None) -> DataFrame:
    """Replace the table ``name`` below ``root`` and read it back; on failure the old one stays."""
    return Snapshots(df.sparkSession, root).refresh(df, name, layout)


def stamp(spark: SparkSession, root: str, report: str, ended_at: datetime) -> None:
    """Record that a report's tables were refreshed; call it after the commit."""
    row = [(report, ended_at)]
    spark.createDataFrame(row, "report string, run_ended_at timestamp").coalesce(1).write.mode(
        "append"
    ).parquet(f"{root}/_freshness")


def last_runs(spark: SparkSession, root: str) -> DataFrame:
    """Latest refresh of each report."""
    stamps = spark.read.parquet(f"{root}/_freshness")
    return stamps.groupBy("report").agg(F.max("run_ended_at").alias("run_ended_at"))
