"""The operator queries as DuckDB SQL."""

from __future__ import annotations

from boardroll.catalog.oracle_plans import key, sy, weekday, weekdays

_ORDERS = "(SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)"
_EVENTS = "(SELECT *, CAST(ts AS DATE) AS day FROM events)"
_SPANS = f"""(SELECT o_custkey, o_orderkey, o_orderstatus, day AS start, day + CAST(o_orderkey % 120 AS INTEGER) AS stop
              FROM {_ORDERS} AS o)"""


def _merged(keys: str) -> str:
    return f"""
        WITH starts AS (SELECT {keys}, start, max(stop) AS stop FROM {_SPANS} AS s GROUP BY ALL),
             linked AS (SELECT *, lag(stop) OVER (PARTITION BY {keys} ORDER BY start) AS before FROM starts),
             numbered AS (SELECT *, sum(CASE WHEN {weekdays('before', 'start')} <= 1 THEN 0 ELSE 1 END)
                                    OVER (PARTITION BY {keys} ORDER BY start) AS island FROM linked)
        SELECT {keys}, CAST(island AS BIGINT) AS island_id, min(start) AS start, max(stop) AS "end" FROM numbered GROUP BY {keys}, island"""


_LIVES = f"""(SELECT c_custkey, c_mktsegment, c_acctbal, CAST(datediff('month', min(day), max(day)) AS INTEGER) AS age
              FROM customer JOIN {_ORDERS} AS o ON o_custkey = c_custkey GROUP BY ALL)"""
_CURVE = f"""
    lives AS (SELECT *, least(greatest(age, 50), 79) AS boxed FROM {_LIVES} AS l),
    ages AS (SELECT CAST(unnest(generate_series(50, 79)) AS INTEGER) AS age),
    counts AS (SELECT a.age, (SELECT count(*) FROM lives l WHERE l.c_acctbal < 3000 AND l.boxed = a.age) AS n_events,
                      (SELECT count(*) FROM lives l WHERE l.c_acctbal >= 3000 AND l.age = a.age) AS n_censored FROM ages a),
    risk AS (SELECT c.*, (SELECT CAST(sum(d.n_events + d.n_censored) AS BIGINT) FROM counts d WHERE d.age >= c.age) AS n_survivors FROM counts c),
    rates AS (SELECT *, CASE WHEN n_survivors > 0 THEN CAST(n_events AS DOUBLE) / n_survivors END AS rate FROM risk)"""

_MODE = "['1', '5', 'J', 'H', 'L', '2', 'M', 'G', 'E', '6', 'P', 'F', 'D', '3', '4', 'X'][l_partkey % 16 + 1]"

OPERATOR_ORACLES = {
    "project_rename": "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key FROM nation",
    "recency_join": f"""
        SELECT o_orderkey, o_custkey, c_mktsegment, day FROM {_ORDERS} AS o JOIN customer ON c_custkey = o_custkey
        WHERE day >= DATE '1998-07-01'""",
    "reason_inclusion": """
        SELECT user_id, event_type, CASE WHEN event_type IN ('purchase', 'signup') THEN 'Counted' END AS category,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS is_counted
        FROM events WHERE event_type <> 'error' GROUP BY ALL""",
    "case_ladder": """
        SELECT p_partkey, CASE WHEN p_size <= 10 AND p_type IN ('ECONOMY', 'SMALL') THEN 'small cheap' WHEN p_size <= 10 AND p_type = 'PROMO' THEN 'small promo'
               WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'middle' WHEN p_type = 'LARGE' THEN 'large' ELSE '-' END AS label FROM part""",
    "null_or_blank_dash": """
        SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '-' ELSE c_mktsegment END AS segment FROM customer""",
    "semi_in": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
    "anti_not_in": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
    "anti_not_in_null_keys": """
        SELECT c_custkey, key FROM (SELECT *, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS key FROM customer) AS keyed
        WHERE key NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
    "anti_not_in_null_listed": """
        WITH holed AS (SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS listed FROM orders WHERE o_totalprice > 400000)
        SELECT c_custkey, 'with nulls' AS list FROM customer WHERE c_custkey NOT IN (SELECT listed FROM holed)
        UNION ALL
        SELECT c_custkey, 'without' FROM customer WHERE c_custkey NOT IN (SELECT listed FROM holed WHERE listed IS NOT NULL)""",
    "anti_not_exists": """
        SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
               AND l_returnflag = 'R' AND l_extendedprice * 10 > o_totalprice)""",
    "like_patterns": """
        SELECT p_partkey, p_name LIKE 'red%' AS starts, p_name LIKE '%bolt%' AS holds, p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AS in_class,
               p_brand LIKE 'Brand#1_' AS one_more FROM part""",
    "param_filter_report": """
        SELECT n_name, c_custkey, c_name, c_mktsegment FROM customer JOIN nation ON n_nationkey = c_nationkey
        WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') AND n_nationkey IN (1, 3, 8) AND c_name ILIKE '%r#00000%'""",
    "slicer_values": "SELECT DISTINCT c_mktsegment FROM customer ORDER BY 1",
    "seed_code_flag": """
        SELECT s_suppkey, s_nationkey, s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2) AS listed FROM supplier""",
    "left_lookup_decode": """
        SELECT o_orderkey, o_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name END AS builder FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "full_outer_delta": f"""
        SELECT day, count(*) FILTER (n = 1) AS n_in, count(*) FILTER (n = -1) AS n_out, CAST(sum(n) AS BIGINT) AS delta
        FROM (SELECT day, 1 AS n FROM {_ORDERS} AS o UNION ALL SELECT CAST(l_shipdate AS DATE), -1 FROM lineitem) AS moves GROUP BY day""",
    "range_join_interval": f"""
        SELECT s.o_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey
        JOIN {_ORDERS} AS s ON s.o_custkey = o.o_custkey AND l_shipdate >= s.day AND l_shipdate <= s.day + 60 GROUP BY ALL""",
    "interval_overlap_join": f"""
        SELECT f.o_custkey, f.o_orderkey AS filled_key, p.o_orderkey AS open_key, greatest(f.day, p.day) AS shared_from,
               CAST(least(f.day + 90, p.day + 45) AS DATE) AS shared_until,
               CAST(least(f.day + 90, p.day + 45) - greatest(f.day, p.day) + 1 AS INTEGER) AS n_days
        FROM {_ORDERS} AS f JOIN {_ORDERS} AS p ON p.o_custkey = f.o_custkey AND p.day <= f.day + 90 AND f.day <= p.day + 45
        WHERE f.o_orderstatus = 'F' AND p.o_orderstatus = 'O'""",
    "cross_pad_zero_fill": f"""
        SELECT r_name, d.day, (SELECT count(*) FROM {_ORDERS} AS o JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
                               WHERE n_regionkey = r_regionkey AND o.day = d.day) AS n_orders
        FROM region JOIN (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders) AS d ON true""",
    "lateral_split_explode": "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part",
    "group_expr": """
        SELECT CASE WHEN l_quantity < 10 THEN 'few' WHEN l_quantity < 30 THEN 'some' ELSE 'many' END AS size, CAST(year(l_shipdate) AS INTEGER) AS year,
               count(*) AS n_lines, min(l_quantity) AS low, max(l_quantity) AS high, round(avg(l_discount), 6) AS mean_discount FROM lineitem GROUP BY ALL""",
    "count_distinct": """
        SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY ALL""",
    "conditional_rate": """
        SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS n_returned, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0 END), 6) AS rate
        FROM lineitem GROUP BY ALL""",
    "weighted_mean": """
        SELECT l_returnflag, l_linestatus, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS mean FROM lineitem GROUP BY ALL""",
    "pick_by_max": "SELECT o_custkey, min(o_orderpriority) AS first_priority, max(o_orderstatus) AS last_status FROM orders GROUP BY ALL",
    "wide_nonnull_count": f"SELECT user_id, day, CAST(count(DISTINCT event_type) AS INTEGER) AS n_types FROM {_EVENTS} AS e GROUP BY ALL",
    "cube_labelled": f"""
        WITH rows AS (SELECT {sy('day')} AS school_year, c_mktsegment, o_orderstatus, o_orderpriority, o_totalprice
                      FROM {_ORDERS} AS o JOIN customer ON c_custkey = o_custkey),
             cubed AS (SELECT school_year, coalesce(c_mktsegment, 'All segments') AS c_mktsegment, coalesce(o_orderstatus, 'All') AS o_orderstatus,
                              coalesce(o_orderpriority, 'All') AS o_orderpriority, count(*) AS n_orders, CAST(floor(round(sum(o_totalprice), 2) / count(*)) AS BIGINT) AS mean_price
                       FROM rows GROUP BY school_year, CUBE (c_mktsegment, o_orderstatus, o_orderpriority))
        SELECT *, {key('school_year', 'c_mktsegment', 'o_orderstatus', 'o_orderpriority')} AS filter_key FROM cubed""",
    "cube_total_selfjoin": """
        WITH cubed AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, coalesce(l_returnflag, 'All') AS l_returnflag, coalesce(l_linestatus, 'All') AS l_linestatus,
                              sum(l_discount * l_quantity) / sum(l_quantity) AS rate FROM lineitem GROUP BY year(l_shipdate), CUBE (l_returnflag, l_linestatus))
        SELECT c.year, c.l_returnflag, c.l_linestatus, round(c.rate, 6) AS rate, round(a.rate, 6) AS total_rate
        FROM cubed c LEFT JOIN cubed a ON a.year = c.year AND a.l_returnflag = 'All' AND a.l_linestatus = 'All'""",
    "row_level_cube": f"""
        WITH rows AS (SELECT c_custkey, CASE WHEN a.keep THEN c_mktsegment ELSE 'All' END AS c_mktsegment, CASE WHEN b.keep THEN n_name ELSE 'All' END AS n_name,
                             CASE WHEN c.keep THEN r_name ELSE 'All' END AS r_name
                      FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
                      JOIN (VALUES (true), (false)) AS a(keep) ON true JOIN (VALUES (true), (false)) AS b(keep) ON true JOIN (VALUES (true), (false)) AS c(keep) ON true)
        SELECT *, {key('c_mktsegment', 'n_name', 'r_name')} AS filter_key FROM rows""",
    "top1_latest": f"""
        SELECT o_custkey, o_orderkey, day, o_totalprice FROM {_ORDERS} AS o
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC, o_orderkey DESC) = 1""",
    "row_number_ordinal": f"""
        SELECT DISTINCT o_orderstatus, day, CAST(dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY day) AS INTEGER) AS day_id FROM {_ORDERS} AS o""",
    "window_distinct": "SELECT event_id, user_id, count(DISTINCT event_type) OVER (PARTITION BY user_id) AS n_types FROM events",
    "lag_change_flag": """
        SELECT event_id, user_id, lag(event_type) OVER u AS before, CASE WHEN lag(event_type) OVER u = event_type THEN 1 ELSE 0 END AS repeats
        FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "last_value_frame": """
        SELECT event_id, user_id, last_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_type FROM events""",
    "running_sum": """
        SELECT event_id, event_type, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS running_value FROM events""",
    "sum_preceding": """
        SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS n_before FROM orders""",
    "partition_share": """
        SELECT l_returnflag, l_suppkey, round(quantity / sum(quantity) OVER (PARTITION BY l_returnflag), 6) AS share
        FROM (SELECT l_returnflag, l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL) AS sums""",
    "partition_max": f"""
        SELECT o_orderkey, CASE WHEN o_totalprice = max(o_totalprice) OVER (PARTITION BY o_custkey, {sy('o_orderdate')}) THEN 1 ELSE 0 END AS is_top FROM orders""",
    "islands_by_day": f"""
        WITH days AS (SELECT DISTINCT user_id, day FROM {_EVENTS} AS e),
             runs AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run FROM days)
        SELECT user_id, dense_rank() OVER (PARTITION BY user_id ORDER BY run) - 1 AS island_id, min(day) AS first_day, max(day) AS last_day, count(*) AS n_days
        FROM runs GROUP BY user_id, run""",
    "merge_intervals_weekday": _merged("o_custkey, o_orderstatus"),
    "headcount_delta": f"""
        WITH spans AS (SELECT o_orderstatus, o_orderkey, least(day, CAST(max(l_shipdate) AS DATE)) AS enters, greatest(day, CAST(max(l_shipdate) AS DATE)) AS leaves
                       FROM {_ORDERS} AS o JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderstatus, o_orderkey, day),
             moves AS (SELECT o_orderstatus, enters AS day, 1 AS n FROM spans UNION ALL SELECT o_orderstatus, leaves, -1 FROM spans)
        SELECT o_orderstatus, day, CAST(sum(sum(n)) OVER (PARTITION BY o_orderstatus ORDER BY day) AS BIGINT) AS n_open FROM moves GROUP BY o_orderstatus, day""",
    "forward_fill": f"""
        WITH daily AS (SELECT user_id, day, arg_max(value, ts) AS value FROM {_EVENTS} AS e GROUP BY ALL),
             grid AS (SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM daily GROUP BY user_id)
        SELECT g.user_id, g.day, d.value FROM grid g ASOF LEFT JOIN daily d ON d.user_id = g.user_id AND d.day <= g.day""",
    "forward_fill_hot_keys": """
        SELECT event_id, user_id % 3 AS bucket, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
               OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_paid FROM events""",
    "expand_years": f"""
        SELECT CAST(y.y AS INTEGER) AS school_year, o_orderstatus, count(*) AS n_orders FROM {_ORDERS} AS o
        JOIN (SELECT unnest(generate_series(1990, 2010)) AS y) AS y ON y.y BETWEEN {sy('day')} AND {sy("(day + CAST(o_orderkey % 900 AS INTEGER))")} GROUP BY ALL""",
    "scd_from_log": f"""
        WITH moves AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS before FROM {_EVENTS} AS e),
             changes AS (SELECT user_id, day, arg_max(event_type, ts) AS event_type FROM moves WHERE event_type IS DISTINCT FROM before GROUP BY ALL)
        SELECT user_id, event_type, day AS valid_from, coalesce(lead(day) OVER (PARTITION BY user_id ORDER BY day), DATE '2024-02-01') AS valid_until FROM changes""",
    "as_of_log_state": f"""
        WITH grouped AS (SELECT *, user_id % 7 AS user_group FROM {_EVENTS} AS e),
             moves AS (SELECT *, lag(event_type) OVER (PARTITION BY user_group ORDER BY ts, event_type) AS before FROM grouped WHERE event_type <> 'click'),
             changes AS (SELECT user_group, day, event_type FROM moves WHERE event_type IS DISTINCT FROM before
                         QUALIFY row_number() OVER (PARTITION BY user_group, day ORDER BY ts DESC, event_type DESC) = 1),
             spans AS (SELECT *, coalesce(lead(day) OVER (PARTITION BY user_group ORDER BY day), DATE '2024-02-01') AS until FROM changes)
        SELECT g.event_id, g.user_group, g.day, s.event_type AS in_force FROM grouped g LEFT JOIN spans s
            ON s.user_group = g.user_group AND g.day >= s.day AND g.day < s.until""",
    "clashing_spans": f"""
        SELECT o_custkey, day AS start, CAST(day + CAST(o_orderkey % 120 AS INTEGER) AS DATE) AS until FROM {_ORDERS} AS o
        QUALIFY max(day + CAST(o_orderkey % 120 AS INTEGER)) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey % 120
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= day""",
    "running_peak": f"""
        SELECT o_orderkey, o_orderpriority, max(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY day, o_orderkey) AS peak FROM {_ORDERS} AS o""",
    "snapshot_refresh": f"""
        SELECT o_orderkey, o_custkey, o_totalprice, {sy('o_orderdate')} AS school_year FROM orders""",
    "lookup_by_filter": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_partkey BETWEEN 1 AND 20",
    "bucketed_join": "SELECT o_custkey AS custkey, o_orderkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey",
    "stamped_table": "SELECT n_nationkey, n_name, '2021-07-01 05:00:00' AS ended FROM nation",
    "seed_by_header": """
        SELECT s_suppkey, CASE WHEN n_regionkey <> 1 THEN 'region, ' || n_regionkey END AS descr,
               CASE WHEN n_regionkey <> 1 THEN n_regionkey % 2 = 0 END AS is_qualified
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "point_in_time_pick": f"""
        SELECT o_custkey, CAST(y.y AS INTEGER) AS year, o_orderkey, o_totalprice FROM {_ORDERS} AS o
        JOIN (SELECT unnest(generate_series(1995, 2000)) AS y) AS y ON o.day <= make_date(y.y, 9, 30)
        QUALIFY row_number() OVER (PARTITION BY o_custkey, y.y ORDER BY day DESC, o_orderkey DESC) = 1""",
    "school_year": f"""
        SELECT {sy('o_orderdate')} AS from_july, {sy('o_orderdate', 9)} AS from_september, count(*) AS n_orders FROM orders GROUP BY ALL""",
    "surrogate_key": f"""
        SELECT o_orderkey, {key('o_orderkey', 'o_custkey', "nullif(o_orderstatus, 'P')", 'o_orderpriority', 'CAST(o_orderdate AS DATE)')} AS key FROM orders""",
    "resolve_main_flag": f"""
        WITH rows AS (SELECT o_custkey, {sy('o_orderdate')} AS school_year, o_orderkey, CAST(o_totalprice > 450000 AS INTEGER) AS known,
                             CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS preferred FROM orders)
        SELECT o_custkey, school_year, o_orderkey, CASE WHEN max(known) OVER g = 1 THEN known WHEN count(*) OVER g = 1 THEN 1
               WHEN max(preferred) OVER g = 1 THEN preferred WHEN o_orderkey = max(o_orderkey) OVER g THEN 1 ELSE 0 END AS is_main
        FROM rows WINDOW g AS (PARTITION BY o_custkey, school_year)""",
    "survival_curve": f"""
        WITH {_CURVE}
        SELECT age, n_events, n_censored, n_survivors, round(rate, 6) AS instantaneous_death_rate,
               round((SELECT product(1 - coalesce(b.rate, 0)) FROM rates b WHERE b.age <= a.age), 6) AS survival_rate FROM rates a""",
    "cohort_forecast": f"""
        WITH {_CURVE},
             cohorts AS (SELECT age, c_mktsegment, count(*) AS n FROM lives WHERE c_acctbal >= 3000 GROUP BY ALL),
             steps AS (SELECT c.*, h.h, c.n - c.n * (SELECT product(1 - coalesce(r.rate, 0)) FROM rates r WHERE r.age BETWEEN c.age AND c.age + h.h) AS gone
                       FROM cohorts c JOIN (SELECT unnest(generate_series(0, 5)) AS h) AS h ON c.age + h.h BETWEEN 50 AND 79),
             moves AS (SELECT *, round(gone) - coalesce(lag(round(gone)) OVER (PARTITION BY age, c_mktsegment ORDER BY h), 0) AS exits FROM steps)
        SELECT CAST(h AS INTEGER) AS forecast_horizon, c_mktsegment, sum(exits) AS n_exits FROM moves GROUP BY ALL""",
    "allocate_prorata": """
        WITH parts AS (SELECT l_orderkey, l_linenumber, round(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END), 2) AS part,
                              max(l_linestatus) = 'O' AS keep FROM lineitem GROUP BY ALL),
             totals AS (SELECT *, round(sum(part) OVER (PARTITION BY l_orderkey), 2) AS total FROM parts)
        SELECT l_orderkey, l_linenumber,
               round(CASE WHEN part = 0 AND keep THEN o_totalprice / nullif(count(*) FILTER (keep AND part = 0 AND total = 0) OVER (PARTITION BY l_orderkey), 0)
                    WHEN part = 0 THEN 0 ELSE o_totalprice * (part / total) END, 4) AS share
        FROM totals JOIN orders ON o_orderkey = l_orderkey""",
    "unit_conversion": f"""
        SELECT {_MODE} AS mode, count(*) AS n_lines, round(sum(l_quantity * CASE {_MODE} WHEN '1' THEN 6.4 WHEN '5' THEN 6.4 WHEN 'J' THEN 6.4
               WHEN 'H' THEN 1 WHEN 'L' THEN 1 WHEN '2' THEN 1 WHEN 'M' THEN 1 / 60 WHEN 'G' THEN 1 / 60 WHEN 'E' THEN 1 / 60 WHEN '6' THEN 1 / 60
               WHEN 'P' THEN 1.08 WHEN 'F' THEN 1.5 WHEN 'D' THEN 1.35 WHEN '3' THEN 3.2 WHEN '4' THEN 4.8 END), 4) AS hours FROM lineitem GROUP BY 1""",
    "running_experience": f"""
        SELECT o_custkey, start, "end", CAST(sum("end" - start) OVER (PARTITION BY o_custkey ORDER BY start) AS BIGINT) AS running_days
        FROM ({_merged('o_custkey')}) AS m""",
    "band_age": """
        SELECT CASE WHEN c_acctbal < 0 THEN 'poor' WHEN c_acctbal < 3000 THEN 'low' WHEN c_acctbal < 7000 THEN 'middle' ELSE 'high' END AS band,
               count(*) AS n_customers FROM customer GROUP BY 1""",
    "clip_rate": """
        SELECT l_orderkey, l_linenumber, l_partkey, round(least(l_extendedprice / (l_quantity * 1501), 1.0), 6) AS rate,
               greatest(least(l_quantity, 40), 5) AS quantity FROM lineitem""",
    "union_observed_forecast": f"""
        WITH seen AS (SELECT {sy('o_orderdate')} AS school_year, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
        SELECT school_year + 10 AS school_year, o_orderpriority, NULL::BIGINT AS observed, n AS forecast,
               CAST(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY school_year) AS BIGINT) AS running_forecast, 1 AS is_forecast FROM seen
        UNION ALL SELECT school_year, o_orderpriority, n, NULL, NULL, 0 FROM seen""",
    "filters_union": f"""
        WITH both_sides AS (SELECT c_nationkey AS nation, 'customer' AS source FROM customer UNION SELECT s_nationkey, 'supplier' FROM supplier)
        SELECT n_name, max(source) AS source, {key('nation')} AS filter_key FROM both_sides LEFT JOIN nation ON n_nationkey = nation GROUP BY nation, n_name""",
    "fte_report": """
        SELECT concat(p_brand, ' - ', p_type) AS label, sum(l_quantity) AS hours, round(sum(l_quantity) / 1826.3, 6) AS fte
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1""",
    "event_rate_report": f"""
        WITH e AS (SELECT *, user_id % 4 AS bucket FROM {_EVENTS} AS e),
             users AS (SELECT bucket, count(DISTINCT user_id) AS n_users FROM e GROUP BY ALL),
             days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM e),
             grid AS (SELECT u.bucket, d.day, u.n_users, (SELECT count(DISTINCT x.user_id) FROM e x WHERE x.event_type = 'error' AND x.bucket = u.bucket AND x.day = d.day) AS n_errors
                      FROM users u JOIN days d ON true),
             cubed AS (SELECT day, coalesce(CAST(bucket AS VARCHAR), 'All') AS bucket, CAST(sum(n_errors) AS BIGINT) AS n_errors, CAST(sum(n_users) AS BIGINT) AS n_users
                       FROM grid GROUP BY day, CUBE (bucket))
        SELECT day, bucket, {weekday('day')} AS jour_semaine, n_errors, n_users, round(n_errors / n_users, 6) AS rate,
               round(sum(n_errors) OVER (PARTITION BY bucket) / sum(n_users) OVER (PARTITION BY bucket), 6) AS mean_of_bucket,
               round(sum(n_errors) OVER (PARTITION BY bucket, dayofweek(day)) / sum(n_users) OVER (PARTITION BY bucket, dayofweek(day)), 6) AS mean_of_weekday
        FROM cubed""",
    "string_funcs": """
        SELECT p_partkey, concat(p_name, '/', CASE WHEN p_size > 20 THEN p_type END) AS joined, p_brand[1:5] AS prefix, right(p_type, 3) AS suffix,
               p_type AS trimmed, lower(p_type) AS lowered,
               CASE WHEN length(p_brand || p_type) >= 10 THEN substr(p_brand || p_type, 1, 3) || '-' || substr(p_brand || p_type, 4, 1) || '-'
                    || substr(p_brand || p_type, 5, 5) || '-' || substr(p_brand || p_type, 10) END AS dashed FROM part""",
    "date_funcs": f"""
        SELECT o_orderkey, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, CAST(DATE '2001-01-01' - day AS INTEGER) AS days,
               CAST(datediff('year', day, DATE '2001-01-01') AS INTEGER) AS boundaries, CAST(day + 14 AS DATE) AS in_two_weeks, make_date(year(day), 9, 30) AS sept_30,
               {weekday('day')} AS weekday, day AS parsed, CAST(floor((DATE '2001-01-01' - day) / 365.25) AS INTEGER) AS age,
               CASE WHEN day <= DATE '2001-01-01' THEN CAST((SELECT count(*) FROM generate_series(day + INTERVAL 1 DAY, DATE '2001-01-01', INTERVAL 1 DAY) AS g(d) WHERE isodow(d) < 6) AS INTEGER)
                    ELSE -CAST((SELECT count(*) FROM generate_series(DATE '2001-01-02', day, INTERVAL 1 DAY) AS g(d) WHERE isodow(d) < 6) AS INTEGER) END AS weekdays,
               make_date({sy('day')}, 7, 1) AS year_start FROM {_ORDERS} AS o""",
    "math_funcs": """
        SELECT l_orderkey, l_linenumber, l_partkey, round(exp(l_discount), 6) AS exponential, round(ln(l_quantity), 6) AS logarithm,
               round(l_quantity / 7, 2) AS rounded, CAST(floor(l_extendedprice) AS BIGINT) AS floored,
               round(l_quantity / nullif(l_linenumber - 1, 0), 6) AS safe_ratio FROM lineitem""",
    "cast_funcs": """
        SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(9, 2)) AS DOUBLE) AS amount, CAST(o_orderkey AS VARCHAR) AS text,
               CAST(o_orderpriority[1] AS INTEGER) AS number, TRY_CAST(o_orderpriority AS INTEGER) AS no_number, CAST(o_orderdate AS DATE) AS day FROM orders""",
    "key_uniqueness": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "not_null": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'",
    "accepted_values": "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'R'",
    "accepted_range": "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.08",
    "quality_report": """
        SELECT 'not_null:o_custkey' AS check_name, count(*) FILTER (o_custkey IS NULL) AS n_failures FROM orders
        UNION ALL SELECT 'not_null:o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM orders
        UNION ALL SELECT 'accepted_values:o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders
        UNION ALL SELECT 'accepted_range:o_totalprice', count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 400000) FROM orders
        UNION ALL SELECT 'unique:order', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) AS d
        UNION ALL SELECT 'unique:customer_day', count(*) FROM (SELECT o_custkey, o_orderdate FROM orders GROUP BY ALL HAVING count(*) > 1) AS d""",
}
