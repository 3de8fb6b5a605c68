"""The reusable operators run on the driver's own tables; one entry per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boardroll import functions as fn
from boardroll import operators as op
from boardroll.catalog.plan_queries import comparable
from boardroll.sources import Source, flag_codes, project
from boardroll.sources.registry import Column as SourceColumn

AS_OF = date(2001, 8, 31)
CURRENT_YEAR = 2000

Query = Callable[[SparkSession, str], DataFrame]
OPERATORS: dict[str, Query] = {}


class Tables:
    """Driver tables read as ``tables.orders`` and so on."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")


def operator_query(job: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    OPERATORS[job.__name__] = lambda spark, folder: comparable(job(Tables(spark, folder)))
    return job


def _orders(t: Tables) -> DataFrame:
    return t.orders.withColumn("day", F.to_date("o_orderdate"))


def _events(t: Tables) -> DataFrame:
    return t.events.withColumn("day", F.to_date("ts"))


# Scans, projections, predicates.


@operator_query
def project_rename(t: Tables) -> DataFrame:
    columns = (
        SourceColumn("n_nationkey", "int", "nation_key"),
        SourceColumn("n_name", "string", "nation_name"),
        SourceColumn("n_regionkey", "int", "region_key"),
    )
    return project(t.nation, Source("driver", "nation", columns))


@operator_query
def recency_join(t: Tables) -> DataFrame:
    """Orders of the last three school years with their customer's segment."""
    recent = _orders(t).filter(fn.school_year("day") >= CURRENT_YEAR - 2)
    segments = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return recent.join(segments, "o_custkey").select(
        "o_orderkey", "o_custkey", "c_mktsegment", "day"
    )


@operator_query
def reason_inclusion(t: Tables) -> DataFrame:
    """Drop one event type and flag two others, once per user and type."""
    counted = F.col("event_type").isin("purchase", "signup")
    return (
        t.events.filter(F.col("event_type") != "error")
        .select("user_id", "event_type")
        .distinct()
        .select(
            "user_id",
            "event_type",
            F.when(counted, F.lit("Counted")).alias("category"),
            counted.cast("int").alias("is_counted"),
        )
    )


@operator_query
def case_ladder(t: Tables) -> DataFrame:
    small, kind = F.col("p_size") <= 10, F.col("p_type")
    return t.part.select(
        "p_partkey",
        F.when(small & kind.isin("ECONOMY", "SMALL"), "small cheap")
        .when(small, F.when(kind == "PROMO", "small promo").otherwise("small"))
        .when(F.col("p_size").between(11, 30), "middle")
        .when(kind == "LARGE", "large")
        .otherwise("-")
        .alias("label"),
    )


@operator_query
def null_or_blank_dash(t: Tables) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("  ")).when(
        F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")
    )
    return t.customer.select("c_custkey", fn.dash_if_blank(segment).alias("segment"))


@operator_query
def semi_in(t: Tables) -> DataFrame:
    big = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(big, "c_custkey", "left_semi").select("c_custkey", "c_name")


@operator_query
def anti_not_in(t: Tables) -> DataFrame:
    big = t.orders.filter("o_totalprice > 400000")
    return op.not_in(t.customer, "c_custkey", big, "o_custkey").select("c_custkey", "c_name")


@operator_query
def anti_not_in_null_keys(t: Tables) -> DataFrame:
    """NOT IN for keys that may be null: such a row never passes."""
    keyed = t.customer.withColumn("key", F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")))
    big = t.orders.filter("o_totalprice > 400000")
    return op.not_in(keyed, "key", big, "o_custkey").select("c_custkey", "key")


@operator_query
def anti_not_in_null_listed(t: Tables) -> DataFrame:
    """NOT IN per market segment of a list, where a list with a null lets nothing pass."""
    big = t.orders.filter("o_totalprice > 400000")
    holed = big.withColumn("listed", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")))
    passed = [
        op.not_in(t.customer, "c_custkey", rows, "listed").select("c_custkey", F.lit(label).alias("list"))
        for label, rows in (("with nulls", holed), ("without", holed.filter("listed IS NOT NULL")))
    ]
    return passed[0].unionByName(passed[1])


@operator_query
def anti_not_exists(t: Tables) -> DataFrame:
    """Orders without a returned line worth more than a tenth of them."""
    returned = t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey", "l_extendedprice")
    worth = (F.col("o_orderkey") == F.col("l_orderkey")) & (
        F.col("l_extendedprice") * 10 > F.col("o_totalprice")
    )
    return t.orders.join(returned, worth, "left_anti").select("o_orderkey", "o_custkey")


@operator_query
def like_patterns(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.col("p_name").startswith("red").alias("starts"),
        F.col("p_name").contains("bolt").alias("holds"),
        F.col("p_brand").rlike("^Brand#[1-3]$").alias("in_class"),
        F.col("p_brand").like("Brand#1_").alias("one_more"),
    )


@operator_query
def param_filter_report(t: Tables) -> DataFrame:
    """Multi-value parameters and a substring search over a report table."""
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"))
        .join(nations.filter(F.col("n_name").isin("NATION_1", "NATION_3", "NATION_8")), "c_nationkey")
        .filter(F.lower("c_name").contains("r#00000"))
        .select("n_name", "c_custkey", "c_name", "c_mktsegment")
    )


@operator_query
def slicer_values(t: Tables) -> DataFrame:
    return t.customer.select("c_mktsegment").distinct().orderBy("c_mktsegment")


@operator_query
def seed_code_flag(t: Tables) -> DataFrame:
    """Rows whose code is listed by a lookup, without collecting the list."""
    listed = t.nation.filter("n_regionkey = 2").select("n_nationkey")
    flagged = flag_codes(t.supplier, listed, "s_nationkey", "listed")
    return flagged.select("s_suppkey", "s_nationkey", "listed")


# Joins.


@operator_query
def left_lookup_decode(t: Tables) -> DataFrame:
    named = op.decode(
        t.orders, t.customer, "o_custkey", "BUILDING", "builder", "c_custkey", "c_name", "c_mktsegment"
    )
    return named.select("o_orderkey", "o_custkey", "builder")


@operator_query
def full_outer_delta(t: Tables) -> DataFrame:
    """Orders taken and lines shipped per day, whichever of the two exists."""
    taken = _orders(t).groupBy("day").agg(F.count(F.lit(1)).alias("n_in"))
    shipped = t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_out")
    )
    return taken.join(shipped, "day", "full").select(
        "day",
        F.coalesce("n_in", F.lit(0)).alias("n_in"),
        F.coalesce("n_out", F.lit(0)).alias("n_out"),
        (F.coalesce("n_in", F.lit(0)) - F.coalesce("n_out", F.lit(0))).alias("delta"),
    )


@operator_query
def range_join_interval(t: Tables) -> DataFrame:
    """Lines shipped within 60 days of any order of the same customer, per order."""
    customers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_quantity", F.to_date("l_shipdate").alias("shipped"))
    spans = _orders(t).select(
        "o_custkey", "o_orderkey", F.col("day").alias("first"), F.date_add("day", 60).alias("last")
    )
    return (
        op.point_in_interval_join(
            lines.join(customers, "l_orderkey").drop("l_orderkey"),
            spans,
            ["o_custkey"],
            "shipped",
            "first",
            "last",
            buckets=op.Buckets(days=91),
        )
        .groupBy("o_orderkey")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    )


@operator_query
def interval_overlap_join(t: Tables) -> DataFrame:
    """Days shared by filled and open orders of a customer."""
    orders = _orders(t)
    filled = orders.filter("o_orderstatus = 'F'").select(
        "o_custkey",
        F.col("o_orderkey").alias("filled_key"),
        F.col("day").alias("f_start"),
        F.date_add("day", 90).alias("f_end"),
    )
    still_open = orders.filter("o_orderstatus = 'O'").select(
        "o_custkey",
        F.col("o_orderkey").alias("open_key"),
        F.col("day").alias("o_start"),
        F.date_add("day", 45).alias("o_end"),
    )
    pairs = op.overlap_join(
        filled, still_open, ["o_custkey"], ("f_start", "f_end"), ("o_start", "o_end")
    )
    start, end = op.clip_interval(
        F.col("f_start"), F.col("f_end"), F.col("o_start"), F.col("o_end")
    )
    return pairs.select(
        "o_custkey",
        "filled_key",
        "open_key",
        start.alias("shared_from"),
        end.alias("shared_until"),
        (F.datediff(end, start) + 1).alias("n_days"),
    )


@operator_query
def cross_pad_zero_fill(t: Tables) -> DataFrame:
    """Orders per region and day, with zero on days without any."""
    bounds = _orders(t).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    regions = t.region.select("r_regionkey", "r_name")
    grid = op.dense_days(regions, bounds.select("first").scalar(), bounds.select("last").scalar())
    nations = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(
        t.nation.select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey")
        ),
        "c_nationkey",
    )
    counts = (
        _orders(t)
        .join(nations, "o_custkey")
        .groupBy("r_regionkey", "day")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    return op.fill_missing(grid, counts, ["r_regionkey", "day"], {"n_orders": 0}).select(
        "r_name", "day", "n_orders"
    )


@operator_query
def lateral_split_explode(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


# Aggregations and cubes.


@operator_query
def group_expr(t: Tables) -> DataFrame:
    size = F.when(F.col("l_quantity") < 10, "few").when(F.col("l_quantity") < 30, "some").otherwise("many")
    return t.lineitem.groupBy(size.alias("size"), F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("l_quantity").alias("low"),
        F.max("l_quantity").alias("high"),
        F.avg("l_discount").alias("mean_discount"),
    )


@operator_query
def count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("n_parts"),
        F.count_distinct("l_orderkey").alias("n_orders"),
    )


@operator_query
def conditional_rate(t: Tables) -> DataFrame:
    late = (F.col("l_returnflag") == "R").cast("int")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.sum(late).alias("n_returned"), F.avg(late.cast("double")).alias("rate")
    )


@operator_query
def weighted_mean(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        fn.ratio(F.sum(F.col("l_discount") * F.col("l_quantity")), F.sum("l_quantity")).alias("mean")
    )


@operator_query
def pick_by_max(t: Tables) -> DataFrame:
    """Highest and lowest text as 'pick one'."""
    return t.orders.groupBy("o_custkey").agg(
        F.min("o_orderpriority").alias("first_priority"), F.max("o_orderstatus").alias("last_status")
    )


@operator_query
def wide_nonnull_count(t: Tables) -> DataFrame:
    """Number of event types seen per user and day, from one conditional column each."""
    seen = [
        F.bool_or(F.col("event_type") == name).cast("int")
        for name in ("click", "error", "purchase", "signup", "view")
    ]
    return _events(t).groupBy("user_id", "day").agg(sum(seen[1:], seen[0]).alias("n_types"))


def _labelled_orders(t: Tables) -> DataFrame:
    segments = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return (
        _orders(t)
        .join(segments, "o_custkey")
        .withColumn("school_year", fn.school_year("day"))
    )


@operator_query
def cube_labelled(t: Tables) -> DataFrame:
    """Orders and mean price (whole) per school year and every filter, with its key."""
    dims = {"c_mktsegment": "All segments", "o_orderstatus": "All", "o_orderpriority": "All"}
    cube = op.labelled_cube(
        _labelled_orders(t),
        ["school_year"],
        dims,
        {"n_orders": F.count(F.lit(1)), "price": F.sum("o_totalprice")},
    )
    return cube.select(
        "school_year",
        *dims,
        "n_orders",
        F.floor(fn.ratio(F.round("price", 2), "n_orders")).alias("mean_price"),
        fn.surrogate_key("school_year", *dims).alias("filter_key"),
    )


@operator_query
def cube_total_selfjoin(t: Tables) -> DataFrame:
    """Discount per flag and status beside the one over everything, per ship year."""
    lines = t.lineitem.withColumn("year", F.year("l_shipdate"))
    cube = op.labelled_cube(
        lines,
        ["year"],
        {"l_returnflag": "All", "l_linestatus": "All"},
        {"weighted": F.sum(F.col("l_discount") * F.col("l_quantity")), "weight": F.sum("l_quantity")},
    ).withColumn("rate", fn.ratio("weighted", "weight"))
    total = cube.filter("l_returnflag = 'All' AND l_linestatus = 'All'").select(
        "year", F.col("rate").alias("total_rate")
    )
    return cube.join(total, "year", "left").select(
        "year", "l_returnflag", "l_linestatus", "rate", "total_rate"
    )


@operator_query
def row_level_cube(t: Tables) -> DataFrame:
    """Each customer once per choice of shown dimensions."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"
    )
    rows = t.customer.join(places, "c_nationkey").select(
        "c_custkey", "c_mktsegment", "n_name", "r_name"
    )
    dims = ["c_mktsegment", "n_name", "r_name"]
    cube = op.row_cube(rows, dims, "All")
    return cube.withColumn("filter_key", fn.surrogate_key(*dims))


# Windows and ordered scans.


@operator_query
def top1_latest(t: Tables) -> DataFrame:
    last = op.latest(
        _orders(t), ["o_custkey"], F.col("day").desc(), F.col("o_orderkey").desc()
    )
    return last.select("o_custkey", "o_orderkey", "day", "o_totalprice")


@operator_query
def row_number_ordinal(t: Tables) -> DataFrame:
    """Ordinal of each active day of a status, over the distinct days only."""
    window = Window.partitionBy("o_orderstatus").orderBy("day")
    days = _orders(t).select("o_orderstatus", "day").distinct()
    return days.withColumn("day_id", F.row_number().over(window))


@operator_query
def window_distinct(t: Tables) -> DataFrame:
    """Number of distinct types of the user beside each event, joined from an aggregate."""
    types = t.events.groupBy("user_id").agg(F.count_distinct("event_type").alias("n_types"))
    return t.events.join(types, "user_id").select("event_id", "user_id", "n_types")


@operator_query
def lag_change_flag(t: Tables) -> DataFrame:
    """Whether an event is of the type of the user's event before it."""
    before = op.previous_value(
        _events(t), ["user_id"], ["ts", "event_id"], F.col("event_type"), "before"
    )
    same = F.coalesce(F.col("before") == F.col("event_type"), F.lit(False)).cast("int")
    return before.select("event_id", "user_id", "before", same.alias("repeats"))


@operator_query
def last_value_frame(t: Tables) -> DataFrame:
    """The user's last event type beside each event."""
    last = t.events.groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type")
    )
    return t.events.join(last, "user_id").select("event_id", "user_id", "last_type")


@operator_query
def running_sum(t: Tables) -> DataFrame:
    """Running value per event type: five keys, so each holds a fifth of all rows."""
    summed = op.running_sum(
        _events(t),
        ["event_type"],
        ["ts", "event_id"],
        F.col("value"),
        "running_value",
    )
    return summed.select("event_id", "event_type", F.round("running_value", 2).alias("running_value"))


@operator_query
def sum_preceding(t: Tables) -> DataFrame:
    """Number of earlier orders of the same priority."""
    counted = op.running_sum(
        _orders(t),
        ["o_orderpriority"],
        ["day", "o_orderkey"],
        F.lit(1),
        "n_before",
        include_current=False,
    )
    return counted.select("o_orderkey", "o_orderpriority", F.coalesce("n_before", F.lit(0)).alias("n_before"))


@operator_query
def partition_share(t: Tables) -> DataFrame:
    """Share of each supplier's lines in the total of their return flag."""
    lines = t.lineitem.groupBy("l_returnflag", "l_suppkey").agg(F.sum("l_quantity").alias("quantity"))
    totals = lines.groupBy("l_returnflag").agg(F.sum("quantity").alias("total"))
    return lines.join(totals, "l_returnflag").select(
        "l_returnflag", "l_suppkey", fn.ratio("quantity", "total").alias("share")
    )


@operator_query
def partition_max(t: Tables) -> DataFrame:
    """Orders that are the dearest of their customer and school year."""
    orders = _orders(t).withColumn("school_year", fn.school_year("day"))
    top = orders.groupBy("o_custkey", "school_year").agg(F.max("o_totalprice").alias("top_price"))
    return orders.join(top, ["o_custkey", "school_year"]).select(
        "o_orderkey", (F.col("o_totalprice") == F.col("top_price")).cast("int").alias("is_top")
    )


# Composite operators.


@operator_query
def islands_by_day(t: Tables) -> DataFrame:
    """Runs of consecutive active days per user."""
    days = _events(t).select("user_id", "day").distinct()
    numbered = days.withColumn("position", F.datediff("day", F.lit(date(1970, 1, 1))))
    return (
        op.island_ids(numbered, ["user_id"], "position")
        .groupBy("user_id", "island_id")
        .agg(
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.count(F.lit(1)).alias("n_days"),
        )
    )


def _spans(t: Tables) -> DataFrame:
    days = (F.col("o_orderkey") % 120).cast("int")
    return _orders(t).select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.col("day").alias("start"), F.date_add("day", days).alias("end")
    )


@operator_query
def merge_intervals_weekday(t: Tables) -> DataFrame:
    return op.merge_intervals(_spans(t), ["o_custkey", "o_orderstatus"], "start", "end", 1)


@operator_query
def headcount_delta(t: Tables) -> DataFrame:
    """Orders in progress per status: from the order to its last line's shipment."""
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.to_date("l_shipdate")).alias("shipped")
    )
    spans = _orders(t).join(shipped, "o_orderkey").select(
        "o_orderstatus",
        "o_orderkey",
        F.least("day", "shipped").alias("enters"),
        F.greatest("day", "shipped").alias("leaves"),
    )
    return op.headcount(
        spans, ["o_orderstatus"], "enters", "leaves", "o_orderkey", "day", "n_open"
    )


@operator_query
def forward_fill(t: Tables) -> DataFrame:
    """Last value known on each day from a user's first day to their last."""
    events = _events(t)
    daily = events.groupBy("user_id", "day").agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("value")
    )
    bounds = daily.groupBy("user_id").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    grid = op.dense_days(bounds, F.col("first"), F.col("last")).select("user_id", "day")
    filled = grid.join(daily, ["user_id", "day"], "left")
    return op.carry_forward(filled, ["user_id"], ["day"], "value", chunk_rows=None)


@operator_query
def forward_fill_hot_keys(t: Tables) -> DataFrame:
    """Last purchase value at or before each event, per region-sized group of users."""
    events = _events(t).withColumns(
        {
            "bucket": F.col("user_id") % 3,
            "paid": F.when(F.col("event_type") == "purchase", F.col("value")),
        }
    )
    filled = op.carry_forward(
        events, ["bucket"], ["ts", "event_id"], "paid", "last_paid"
    )
    return filled.select("event_id", "bucket", "last_paid")


@operator_query
def expand_years(t: Tables) -> DataFrame:
    """Orders alive per school year and status, from an interval of up to 900 days."""
    days = (F.col("o_orderkey") % 900).cast("int")
    spans = _orders(t).withColumn("until", F.date_add("day", days))
    return (
        op.expand_years(spans, "day", "until")
        .groupBy("school_year", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


@operator_query
def scd_from_log(t: Tables) -> DataFrame:
    """Event type in force per user, read as a change log by day."""
    return op.changes_to_intervals(
        _events(t), "user_id", "day", "event_type", "ts", F.lit(date(2024, 2, 1))
    )


@operator_query
def as_of_log_state(t: Tables) -> DataFrame:
    """Event type in force, by the change log of the day, at each event of the same user group.

    The log's intervals are disjoint by construction; an event may come before the first.
    """
    events = _events(t).withColumn("user_group", F.col("user_id") % 7)
    log = op.changes_to_intervals(
        events.where("event_type <> 'click'"), "user_group", "day", "event_type", "ts", F.lit(date(2024, 2, 1))
    )
    spans = log.select("user_group", F.col("event_type").alias("in_force"), "valid_from", F.date_sub("valid_until", 1).alias("valid_to"))
    points = events.select("event_id", "user_group", "day")
    return op.as_of_join(points, spans, ["user_group"], "day", "valid_from", "valid_to", "left")


@operator_query
def clashing_spans(t: Tables) -> DataFrame:
    """Orders whose span shares a day with an earlier one of their customer."""
    spans = _spans(t).select("o_custkey", "o_orderkey", "start", F.col("end").alias("until"))
    return op.clashing_intervals(spans, ["o_custkey"], "start", "until").select("o_custkey", "start", "until")


@operator_query
def running_peak(t: Tables) -> DataFrame:
    """Dearest order of the priority up to each order."""
    peak = op.running_max(
        _orders(t), ["o_orderpriority"], ["day", "o_orderkey"], F.col("o_totalprice"), "peak"
    )
    return peak.select("o_orderkey", "o_orderpriority", "peak")


@operator_query
def point_in_time_pick(t: Tables) -> DataFrame:
    """Order in force on 30 September of each year, per customer."""
    last_of_day = op.latest(_orders(t), ["o_custkey", "day"], F.col("o_orderkey").desc())
    following = F.lead("day").over(Window.partitionBy("o_custkey").orderBy("day"))
    held = last_of_day.withColumn(
        "until", F.coalesce(F.date_sub(following, 1), F.lit(AS_OF))
    )
    first, last = F.year("day"), F.year("until")
    years = held.withColumn("year", F.explode(F.when(first <= last, F.sequence(first, last))))
    on_day = fn.day_of_year("year", 9, 30).between(F.col("day"), F.col("until"))
    return years.filter(on_day).select("o_custkey", "year", "o_orderkey", "o_totalprice")


@operator_query
def school_year(t: Tables) -> DataFrame:
    return (
        _orders(t)
        .groupBy(fn.school_year("day", 7).alias("from_july"), fn.school_year("day", 9).alias("from_september"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


@operator_query
def surrogate_key(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return _orders(t).select(
        "o_orderkey",
        fn.surrogate_key("o_orderkey", "o_custkey", status, "o_orderpriority", "day").alias("key"),
    )


@operator_query
def resolve_main_flag(t: Tables) -> DataFrame:
    """Main order of each customer and school year, by known, only, preferred, highest."""
    orders = _orders(t).withColumn("school_year", fn.school_year("day"))
    known = (F.col("o_totalprice") > 450000).cast("int")
    preferred = (F.col("o_orderpriority") == "1-URGENT").cast("int")
    flagged = op.resolve_flag(
        orders, ["o_custkey", "school_year"], "o_orderkey", known, preferred
    )
    return flagged.select("o_custkey", "school_year", "o_orderkey", "is_main")


def _lifetimes(t: Tables) -> DataFrame:
    """Months between a customer's first and last order, beside the account balance."""
    months = _orders(t).groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        (
            (F.year(F.max("day")) - F.year(F.min("day"))) * 12
            + F.month(F.max("day"))
            - F.month(F.min("day"))
        ).alias("age")
    )
    return t.customer.join(months, "c_custkey").select("c_custkey", "c_mktsegment", "c_acctbal", "age")


def _curve(t: Tables) -> DataFrame:
    lives = _lifetimes(t)
    return op.survival_curve(
        lives.filter("c_acctbal < 3000"), lives.filter("c_acctbal >= 3000"), "age", 50, 79
    )


@operator_query
def survival_curve(t: Tables) -> DataFrame:
    return _curve(t)


@operator_query
def cohort_forecast(t: Tables) -> DataFrame:
    cohorts = (
        _lifetimes(t)
        .filter(F.col("c_acctbal") >= 3000)
        .groupBy("age", "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n_employees"))
    )
    return op.forecast_exits(cohorts, _curve(t), "c_mktsegment")


@operator_query
def allocate_prorata(t: Tables) -> DataFrame:
    """Price of an order shared over its lines; returned lines weigh nothing."""
    weight = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).otherwise(0.0)
    parts = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.round(F.sum(weight), 2).alias("part"), F.max("l_linestatus").alias("status")
    )
    totals = parts.groupBy("l_orderkey").agg(F.round(F.sum("part"), 2).alias("total"))
    prices = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    shared = op.allocate(
        parts.join(totals, "l_orderkey").join(prices, "l_orderkey"),
        ["l_orderkey"],
        quantity="o_totalprice",
        part="part",
        total="total",
        keep_zero=F.col("status") == "O",
        name="share",
    )
    return shared.select("l_orderkey", "l_linenumber", F.round("share", 4).alias("share"))


# Pay modes in the order the line's part selects them.
MODES = ("1", "5", "J", "H", "L", "2", "M", "G", "E", "6", "P", "F", "D", "3", "4", "X")


@operator_query
def unit_conversion(t: Tables) -> DataFrame:
    modes = F.array(*[F.lit(mode) for mode in MODES])
    mode = F.element_at(modes, (F.col("l_partkey") % len(MODES) + 1).cast("int"))
    hours = fn.paid_hours("mode", "l_quantity", F.lit(6.4), F.lit(1080.0))
    return (
        t.lineitem.withColumn("mode", mode)
        .groupBy("mode")
        .agg(F.sum(hours).alias("hours"), F.count(F.lit(1)).alias("n_lines"))
        .withColumn("hours", F.round("hours", 4))
    )


@operator_query
def running_experience(t: Tables) -> DataFrame:
    """Days of activity running over a customer's merged intervals."""
    merged = op.merge_intervals(_spans(t), ["o_custkey"], "start", "end", 1)
    return op.running_sum(
        merged,
        ["o_custkey"],
        ["start"],
        F.datediff("end", "start"),
        "running_days",
        chunk_rows=None,  # merging leaves a customer at most one interval per day
    ).select("o_custkey", "start", "end", "running_days")


@operator_query
def band_age(t: Tables) -> DataFrame:
    labels = ("poor", "low", "middle", "high")
    return t.customer.groupBy(fn.band("c_acctbal", (0, 3000, 7000), labels).alias("band")).agg(
        F.count(F.lit(1)).alias("n_customers")
    )


@operator_query
def clip_rate(t: Tables) -> DataFrame:
    rate = fn.ratio(F.col("l_extendedprice"), F.col("l_quantity") * 1501)
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        fn.cap(rate, 1.0).alias("rate"),
        fn.clamp("l_quantity", 5, 40).alias("quantity"),
    )


@operator_query
def union_observed_forecast(t: Tables) -> DataFrame:
    """Orders seen per school year, then a forecast that repeats them with a running total."""
    seen = (
        _orders(t)
        .groupBy(fn.school_year("day").alias("school_year"), "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    so_far = (
        Window.partitionBy("o_orderpriority")
        .orderBy("school_year")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    expected = seen.select(
        (F.col("school_year") + 10).alias("school_year"),
        "o_orderpriority",
        F.lit(None).cast("long").alias("observed"),
        F.col("n").alias("forecast"),
        F.sum("n").over(so_far).alias("running_forecast"),
        F.lit(1).alias("is_forecast"),
    )
    observed = seen.select(
        "school_year",
        "o_orderpriority",
        F.col("n").alias("observed"),
        F.lit(None).cast("long").alias("forecast"),
        F.lit(None).cast("long").alias("running_forecast"),
        F.lit(0).alias("is_forecast"),
    )
    return expected.unionByName(observed)


@operator_query
def filters_union(t: Tables) -> DataFrame:
    """Slicers of two reports, once each, with the last source and the nation's name."""
    both = t.customer.select(
        F.col("c_nationkey").alias("nation"), F.lit("customer").alias("source")
    ).unionByName(
        t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("source"))
    )
    names = t.nation.select(F.col("n_nationkey").alias("nation"), "n_name")
    return (
        both.groupBy("nation")
        .agg(F.max("source").alias("source"))
        .join(names, "nation", "left")
        .select("n_name", "source", fn.surrogate_key("nation").alias("filter_key"))
    )


@operator_query
def fte_report(t: Tables) -> DataFrame:
    """Quantities per brand and kind, as full-time equivalents, summed before the lookup."""
    summed = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum("l_quantity").alias("quantity")
    )
    parts = t.part.select("p_partkey", "p_brand", "p_type")
    return (
        summed.join(parts, "p_partkey", "left")
        .groupBy(fn.concat_blank("p_brand", F.lit(" - "), "p_type").alias("label"))
        .agg(F.sum("quantity").alias("hours"), (F.sum("quantity") / 1826.3).alias("fte"))
    )


@operator_query
def event_rate_report(t: Tables) -> DataFrame:
    """Share of users with an error per day and bucket, zero-filled, with means beside it."""
    events = _events(t).withColumn("bucket", F.col("user_id") % 4)
    users = events.groupBy("bucket").agg(F.count_distinct("user_id").alias("n_users"))
    span = events.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    grid = op.dense_days(users, span.select("first").scalar(), span.select("last").scalar())
    errors = (
        events.filter("event_type = 'error'")
        .groupBy("bucket", "day")
        .agg(F.count_distinct("user_id").alias("n_errors"))
    )
    filled = op.fill_missing(grid, errors, ["bucket", "day"], {"n_errors": 0})
    cube = op.labelled_cube(
        filled.withColumn("bucket", F.col("bucket").cast("string")),
        ["day"],
        {"bucket": "All"},
        {"n_errors": F.sum("n_errors"), "n_users": F.sum("n_users")},
    )
    weekday = fn.french_weekday("day")

    def mean_over(*keys: str) -> F.Column:
        window = Window.partitionBy(*keys)
        return fn.ratio(F.sum("n_errors").over(window), F.sum("n_users").over(window))

    return cube.withColumn("jour_semaine", weekday).select(
        "day",
        "bucket",
        "jour_semaine",
        "n_errors",
        "n_users",
        fn.ratio("n_errors", "n_users").alias("rate"),
        mean_over("bucket").alias("mean_of_bucket"),
        mean_over("bucket", "jour_semaine").alias("mean_of_weekday"),
    )


# Scalar functions.


@operator_query
def string_funcs(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        fn.concat_blank("p_name", F.lit("/"), F.when(F.col("p_size") > 20, F.col("p_type"))).alias("joined"),
        F.left("p_brand", F.lit(5)).alias("prefix"),
        F.right("p_type", F.lit(3)).alias("suffix"),
        F.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("trimmed"),
        F.lower("p_type").alias("lowered"),
        fn.insert_at(F.concat("p_brand", "p_type"), "-", 4, 6, 12).alias("dashed"),
    )


@operator_query
def date_funcs(t: Tables) -> DataFrame:
    reference = F.lit(date(2001, 1, 1))
    return _orders(t).select(
        "o_orderkey",
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        F.datediff(reference, "day").alias("days"),
        fn.year_boundaries("day", reference).alias("boundaries"),
        F.date_add("day", 14).alias("in_two_weeks"),
        fn.day_of_year(F.year("day"), 9, 30).alias("sept_30"),
        fn.french_weekday("day").alias("weekday"),
        fn.yyyymmdd(F.date_format("day", "yyyyMMdd")).alias("parsed"),
        fn.age_on("day", reference).alias("age"),
        fn.weekdays_between("day", reference).alias("weekdays"),
        fn.school_year_start(fn.school_year("day"), 7).alias("year_start"),
    )


@operator_query
def math_funcs(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.exp("l_discount").alias("exponential"),
        F.ln("l_quantity").alias("logarithm"),
        F.round(F.col("l_quantity") / 7, 2).alias("rounded"),
        F.floor("l_extendedprice").alias("floored"),
        fn.ratio("l_quantity", F.col("l_linenumber") - 1).alias("safe_ratio"),
    )


@operator_query
def cast_funcs(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(9,2)").alias("amount"),
        F.col("o_orderkey").cast("string").alias("text"),
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("number"),
        F.col("o_orderpriority").try_cast("int").alias("no_number"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


# Data checks.


@operator_query
def key_uniqueness(t: Tables) -> DataFrame:
    return op.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@operator_query
def not_null(t: Tables) -> DataFrame:
    shown = t.orders.withColumn(
        "status", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    )
    return op.null_rows(shown, "status").select("o_orderkey", "o_custkey")


@operator_query
def accepted_values(t: Tables) -> DataFrame:
    return op.unexpected_values(t.lineitem, "l_returnflag", ["A", "N"]).select(
        "l_orderkey", "l_linenumber", "l_returnflag"
    )


@operator_query
def accepted_range(t: Tables) -> DataFrame:
    return op.outside_range(t.lineitem, "l_discount", 0.02, 0.08).select(
        "l_orderkey", "l_linenumber", "l_discount"
    )


@operator_query
def quality_report(t: Tables) -> DataFrame:
    return op.quality_report(
        t.orders,
        unique={"order": ["o_orderkey"], "customer_day": ["o_custkey", "o_orderdate"]},
        not_null=["o_custkey", "o_orderdate"],
        accepted={"o_orderstatus": ["F", "O"]},
        ranges={"o_totalprice": (1000, 400000)},
    )
