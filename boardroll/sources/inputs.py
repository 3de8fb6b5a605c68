"""The jobs' inputs by name: source tables, a site's own tables, and CSV seeds."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from boardroll.sources.registry import CONTRACTS, SEEDS, SOURCES, project
from boardroll.sources.seeds import read_seed


def typed(df: DataFrame, name: str, ddl: str) -> DataFrame:
    """The declared columns of an input with their types; anything else is pruned."""
    declared = StructType.fromDDL(ddl)
    known = {c.lower() for c in df.columns}
    missing = [f.name for f in declared if f.name.lower() not in known]
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])


class Sources:
    """Named inputs of the jobs, each with the columns and types that are declared for it.

    ``databases`` maps a database name to a function that reads one of its tables;
    ``site`` reads the tables that a site or a parent project supplies under their own
    names; ``seeds`` maps a seed to its CSV file, and a seed without one is empty.
    ``overrides`` replaces any input by a DataFrame, held to the same columns. An input
    that none of these declares comes from ``overrides`` or ``site`` as it is.
    """

    def __init__(
        self,
        spark: SparkSession,
        databases: Mapping[str, Callable[[str], DataFrame]],
        site: Callable[[str], DataFrame] | None = None,
        seeds: Mapping[str, str] | None = None,
        overrides: Mapping[str, DataFrame] | None = None,
    ) -> None:
        self._spark = spark
        self._databases = dict(databases)
        self._site = site
        self._seeds = dict(seeds or {})
        self._overrides = dict(overrides or {})

    def __getitem__(self, name: str) -> DataFrame:
        given = self._overrides.get(name)
        if name in SOURCES:
            source = SOURCES[name]
            if given is not None:
                ddl = ", ".join(f"`{c.name}` {c.type}" for c in source.columns)
                return typed(given, name, ddl)
            return project(self._databases[source.database](source.table), source)
        if name in SEEDS:
            if given is not None:
                return typed(given, name, SEEDS[name])
            return read_seed(self._spark, name, self._seeds.get(name))
        if given is None:
            if self._site is None:
                raise KeyError(f"no reader for the site's table {name}")
            given = self._site(name)
        return typed(given, name, CONTRACTS[name]) if name in CONTRACTS else given
