"""Registered queries against their SQL twins in DuckDB, on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from boardroll.catalog.plan_queries import TABLES
from boardroll.plans.checks import CHECKS
from boardroll.sources import SEEDS

# The training-data operators have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name not in entry.LLM_QUERIES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name not in entry.LLM_ORACLES}
# The ends of the chains run everything before them.
CHAIN_ENDS = [
    "absence_sequences", "padding", "daily_rate_report", "term_rate_report", "kind_distribution_report", "subject_distribution_report",
    "absence_filters_report", "yearly_students", "yearly_addresses", "general_success_rates", "vocational_success_list", "seniority",
    "retirement_forecasts", "retirement_filters_report", "qualification_report", "full_time_report", "manager_schools", "staff_slicers",
    "checks_of_retirement_curve", "checks_of_workplaces", "checks_of_absences_daily", "sources_of_gpi", "sources_of_paie",
]
OPERATORS = [name for name in QUERIES if name in entry.OPERATORS]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{entry.SMALL}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value + 0.0:.6f}"
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


def as_counter(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in records)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()


def test_declared_checks_name_real_tables():
    assert set(CHECKS) <= {*TABLES, *SEEDS}


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", OPERATORS + CHAIN_ENDS)
def test_query_equals_its_twin(spark, duck, name):
    df = QUERIES[name](spark, entry.SMALL)
    twin = duck.execute(ORACLES[name])
    columns = [d[0] for d in twin.description]
    assert sorted(columns) == sorted(df.columns)
    assert as_counter(df.columns, df.collect()) == as_counter(columns, twin.fetchall())


def test_no_query_plans_a_cartesian_product(spark):
    for name in ("padding", "daily_metrics", "cross_pad_zero_fill", "retirement_forecasts", "event_rate_report"):
        plan = QUERIES[name](spark, entry.SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
