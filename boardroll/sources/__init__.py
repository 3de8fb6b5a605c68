"""Typed inputs (source tables and seeds) and the layout of written tables."""

from boardroll.sources.catalog import PLACES, Catalog
from boardroll.sources.inputs import Sources
from boardroll.sources.readers import jdbc_tables, parquet_tables, saved_tables
from boardroll.sources.registry import CONTRACTS, SEEDS, SOURCES, Source, project
from boardroll.sources.seeds import BadSeed, code_labels, flag_codes, read_seed
from boardroll.sources.sinks import LAYOUTS, Layout, Snapshots, last_runs, layout_of, stamp, write_table
from boardroll.sources.staging import Kept, Staging

__all__ = [
    "CONTRACTS",
    "LAYOUTS",
    "PLACES",
    "SEEDS",
    "SOURCES",
    "BadSeed",
    "Catalog",
    "Kept",
    "Layout",
    "Snapshots",
    "Source",
    "Sources",
    "Staging",
    "code_labels",
    "flag_codes",
    "jdbc_tables",
    "last_runs",
    "layout_of",
    "parquet_tables",
    "project",
    "read_seed",
    "saved_tables",
    "stamp",
    "write_table",
]
