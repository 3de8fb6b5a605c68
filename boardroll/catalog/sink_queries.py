"""Queries that write the driver's tables as a run does, and return what is read back.

They write under ``spark.checkpoint.dir``, else the warehouse, into folders of their own, of which
each run keeps the last version only.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardroll.catalog.operator_queries import Tables, operator_query
from boardroll.functions import school_year
from boardroll.sources import Catalog, Layout, Snapshots, last_runs, read_seed, stamp


def _place(t: Tables, name: str) -> tuple[SparkSession, str]:
    spark = t.orders.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return spark, f"{shared.rstrip('/')}/boardroll-queries/{name}"


@operator_query
def snapshot_refresh(t: Tables) -> DataFrame:
    """All orders, by year and customer: refreshed twice, with a version between that nobody commits."""
    tables = Snapshots(*_place(t, "snapshot_refresh"))
    layout = Layout(("school_year",), ("o_custkey",), ("o_custkey",))
    orders = t.orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", school_year(F.to_date("o_orderdate")).alias("school_year")
    )
    tables.refresh(orders.where("o_orderkey % 2 = 0"), "orders", layout)
    tables.stage(orders.where("o_orderkey % 3 = 0"), "orders", layout)
    tables.refresh(orders, "orders", layout)
    tables.vacuum()
    return tables.read("orders")


@operator_query
def lookup_by_filter(t: Tables) -> DataFrame:
    """Lines of the first twenty parts, from a table with a bloom filter on the part."""
    tables = Snapshots(*_place(t, "lookup_by_filter"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    written = tables.refresh(lines, "lines", Layout((), ("l_orderkey",), ("l_partkey",)))
    tables.vacuum()
    return written.where(F.col("l_partkey").isin(*range(1, 21)))


@operator_query
def bucketed_join(t: Tables) -> DataFrame:
    """Orders with their customer, both placed in a catalog database and bucketed by the customer."""
    spark, _ = _place(t, "bucketed_join")
    catalog = Catalog(spark, {"orders": ("sales", "orders"), "customers": ("sales", "customers")}, "boardroll_queries_")
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    for name, table in (("orders", orders), ("customers", customers)):
        catalog.refresh(table, name, Layout(bucket=("custkey",)), buckets=8)
        catalog.vacuum(name)
    return catalog.read("orders").join(catalog.read("customers"), "custkey")


@operator_query
def stamped_table(t: Tables) -> DataFrame:
    """Nations as written, with the latest time at which their report was stamped."""
    spark, root = _place(t, "stamped_table")
    nations = t.nation.select("n_nationkey", "n_name", F.lit("nations").alias("report"))
    tables = Snapshots(spark, root)
    tables.refresh(nations, "nations")
    tables.vacuum()
    for hour in (3, 5, 4):
        stamp(spark, root, "nations", datetime(2021, 7, 1, hour))
    ended = F.date_format("run_ended_at", "yyyy-MM-dd HH:mm:ss").alias("ended")
    return tables.read("nations").join(last_runs(spark, root), "report").select("n_nationkey", "n_name", ended)


@operator_query
def seed_by_header(t: Tables) -> DataFrame:
    """Suppliers with what a seed says of their nation; the seed's columns stand in another order."""
    spark, root = _place(t, "seed_by_header")
    listed = t.nation.where("n_regionkey <> 1").select(
        (F.col("n_regionkey") % 2 == 0).alias("IS_QUALIFIED"),
        F.concat(F.lit("region, "), "n_regionkey").alias("descr"),
        F.col("n_nationkey").alias("code"),
        F.lit("x").alias("more"),
    )
    listed.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{root}/ens_qualification")
    seed = read_seed(spark, "ens_qualification", f"{root}/ens_qualification")
    nation = F.col("s_nationkey").cast("string")
    return t.supplier.withColumn("code", nation).join(seed, "code", "left").select("s_suppkey", "descr", "is_qualified")
