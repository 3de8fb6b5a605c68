"""Tables placed in catalog databases under declared names, bucketed where joins want it."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from boardroll.sources.sinks import Layout, layout_of, with_filters

# The database of each group of tables.
DATABASES = {
    "educ_serv": ("absences_daily", "absence_sequences", "absence_reasons", "daily_students", "daily_grid", "daily_metrics"),
    "human_resources": (
        "activity_yearly", "activity_current", "main_job_yearly", "retirements", "teacher_qualifications", "paid_hours_by_account",
    ),
    "dashboard_absenteeism": (
        "daily_rate_report", "term_rate_report", "kind_distribution_report", "subject_distribution_report", "absence_filters_report",
    ),
    "dashboard_retirement": ("retirement_curve", "retirement_forecasts", "retirement_filters_report"),
    "dashboard_suivi_etc": ("full_time_report",),
    "rls": ("manager_schools", "workplaces"),
}
PLACES = {table: (database, table) for database, tables in DATABASES.items() for table in tables}


class Catalog:
    """Writes tables into catalog databases; readers use plain names such as ``rls.workplaces``.

    ``places`` gives a table's database and alias; ``prefix`` goes before every database, so that
    sites or trial runs stay apart. A refresh writes a table of its own version, and ``commit``
    points the alias, a view, at it. So readers keep the old rows until then, and joins
    still see how the files are bucketed: two tables bucketed alike join on that key without
    a shuffle.
    """

    def __init__(
        self, spark: SparkSession, places: Mapping[str, tuple[str, str]] | None = None, prefix: str = ""
    ) -> None:
        self._spark = spark
        self._places = {n: (prefix + d, a) for n, (d, a) in (PLACES if places is None else places).items()}
        taken: dict[tuple[str, str], str] = {}
        for name, (database, alias) in self._places.items():
            spot = (database.lower(), alias.lower())  # catalog names ignore case
            if spot in taken:
                raise ValueError(f"{taken[spot]} and {name} would both be {database}.{alias}")
            taken[spot] = name
        self._staged: dict[str, str] = {}
        self._columns: dict[str, list[str]] = {}

    def place(self, name: str) -> str:
        """The name under which the table is read."""
        if name not in self._places:
            raise KeyError(f"no place is declared for {name}")
        database, alias = self._places[name]
        return f"`{database}`.`{alias}`"

    def _is_ours(self, name: str) -> bool | None:
        """Whether the alias is a view; None if there is nothing under it."""
        database, alias = self._places[name]
        if not self._spark.catalog.tableExists(f"`{database}`.`{alias}`"):
            return None
        return self._spark.catalog.getTable(f"`{database}`.`{alias}`").tableType == "VIEW"

    def stage(self, df: DataFrame, name: str, layout: Layout | None = None, buckets: int | None = None) -> DataFrame:
        """Write a version of the table, not yet visible under its alias.

        A bucketed table has ``buckets`` buckets, by default as many as a shuffle has partitions,
        each sorted; rows are dealt as they are bucketed, so a folder gets one file a bucket.
        """
        place, layout = self.place(name), layout or layout_of(name)
        database, alias = self._places[name]
        self._spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        if self._is_ours(name) is False:
            raise ValueError(f"{place} is a table that was not written here")
        table = f"{database}.{alias}__{uuid.uuid4().hex}"
        if layout.bucket:
            count = buckets or int(self._spark.conf.get("spark.sql.shuffle.partitions"))
            sort = list(dict.fromkeys([*layout.bucket, *layout.cluster]))
            writer = df.repartition(count, *layout.bucket).write.bucketBy(count, *layout.bucket).sortBy(*sort)
        else:
            ordered = [*layout.partition, *layout.cluster]
            writer = (df.sortWithinPartitions(*ordered) if ordered else df).write
        with_filters(writer, layout).format("parquet").saveAsTable(table)
        self._staged[name] = table
        self._columns[name] = df.columns  # columns of folders come last otherwise
        return self._spark.read.table(table).select(*df.columns)

    def commit(self, names: Sequence[str] | None = None) -> None:
        """Point the aliases at what was staged, of all tables or of those named."""
        for name in list(self._staged if names is None else names):
            columns = ", ".join(f"`{c}`" for c in self._columns.pop(name))
            self._spark.sql(f"CREATE OR REPLACE VIEW {self.place(name)} AS SELECT {columns} FROM {self._staged.pop(name)}")

    def refresh(self, df: DataFrame, name: str, layout: Layout | None = None, buckets: int | None = None) -> DataFrame:
        """Replace one table; read it back under its alias."""
        self.stage(df, name, layout, buckets)
        self.commit([name])
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self._spark.read.table(self.place(name))

    def vacuum(self, name: str) -> int:
        """Drop the versions of a table that its alias does not show; how many they were."""
        database, alias = self._places[name]
        shown = {self._staged.get(name, "").rpartition(".")[2]}
        if self._is_ours(name):
            text = self._spark.sql(f"SHOW CREATE TABLE {self.place(name)}").first()[0]
            shown.add(text.rpartition(".")[2].strip("` \n;"))
        listed = self._spark.sql(f"SHOW TABLES IN `{database}` LIKE '{alias}__*'").collect()
        gone = [r["tableName"] for r in listed if r["tableName"] not in shown]
        for table in gone:
            self._spark.sql(f"DROP TABLE `{database}`.`{table}`")
        return len(gone)
