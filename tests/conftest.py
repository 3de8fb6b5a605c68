import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("boardroll-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small frame from rows and a DDL schema; ISO dates may be given as text."""

    def build(ddl, *rows):
        loose = spark.createDataFrame(rows, _as_text(ddl))
        return loose.selectExpr(
            *[f"CAST({name} AS {type_}) AS {name}" for name, type_ in _fields(ddl)]
        )

    return build


def _fields(ddl):
    return [tuple(part.strip().split(" ", 1)) for part in ddl.split(", ")]


def _as_text(ddl):
    dated = {"date", "timestamp", "decimal(14,2)", "decimal(12,4)"}
    return ", ".join(f"{n} {'string' if t in dated else t}" for n, t in _fields(ddl))


def rows(df, *columns):
    """Rows as sorted tuples with dates as text."""
    picked = df.select(*columns) if columns else df
    out = [
        tuple(v.isoformat() if hasattr(v, "isoformat") else v for v in row)
        for row in picked.collect()
    ]
    return sorted(out, key=lambda r: [(v is None, str(type(v)), v) for v in r])
