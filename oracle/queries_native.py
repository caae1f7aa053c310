"""Oracle SQL of the native bindings and the parity report."""

from __future__ import annotations

from .fragments import history, islands
from .queries import SQL, sql
from .queries_checks import accepted, not_null, rel, row, union, unique

sql("events_latest_per_user_type", (), """
SELECT event_id, user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
WHERE rn = 1
""")

_USER_VERSIONS = f"""
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, last(event_type ORDER BY ts, event_id) AS event_type
  FROM events GROUP BY user_id, CAST(ts AS DATE)
),
user_log AS ({history("daily", "user_id", "day", ("event_type",))}),
versions AS (
  SELECT * RENAME (first_seen AS first_seen_date) FROM ({islands(
    "user_log", "user_id", ("event_type",), "CAST(user_id AS VARCHAR) || '|' || strftime(valid_from, '%Y-%m-%d')",
    "DATE '1900-01-01'", "DATE '9999-12-31'", "user_")})
)
"""
SQL["events_user_scd2"] = _USER_VERSIONS + "SELECT * FROM versions"
SQL["events_pit_purchases"] = _USER_VERSIONS + """
SELECT e.event_id, e.user_id, e.day AS purchase_date, ifnull(v.user_key, '-1') AS user_key,
       v.event_type AS state_in_force
FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase') e
ASOF LEFT JOIN versions v ON v.user_id = e.user_id AND e.day >= v.valid_from
"""

SQL["lineitem_ship_mart"] = """
WITH li AS (SELECT *, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem),
cal AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day, strftime(d, '%A') AS day_name
  FROM (SELECT CAST(unnest(generate_series(
          CAST(make_date(year(min(ship_date)), 1, 1) AS TIMESTAMP),
          CAST(make_date(year(max(ship_date)), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
        FROM li)
)
SELECT c.date_day AS ship_date, c.day_name, p.p_brand,
       count(*) AS lines,
       count(*) FILTER (WHERE l.l_returnflag = 'R') AS returned_lines,
       round(CAST(count(*) FILTER (WHERE l.l_returnflag = 'R') AS DOUBLE) / count(*), 4) AS return_rate,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(15, 2)) * (1 - CAST(l.l_discount AS DECIMAL(15, 2))))
            FILTER (WHERE l.l_returnflag <> 'R') AS DECIMAL(38, 4)) AS net_revenue,
       round(avg(l.l_quantity), 1) AS avg_quantity
FROM li l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN cal c ON CAST(strftime(l.ship_date, '%Y%m%d') AS INTEGER) = c.date_key
GROUP BY ALL
"""

SQL["dq_tpch"] = union(
    unique("orders", "o_orderkey", "orders.o_orderkey"),
    unique("customer", "c_custkey", "customer.c_custkey"),
    not_null("lineitem", "l_orderkey", "lineitem.l_orderkey"),
    not_null("orders", "o_custkey", "orders.o_custkey"),
    rel("orders", "o_custkey", "customer", "c_custkey", "orders.o_custkey"),
    rel("lineitem", "l_orderkey", "orders", "o_orderkey", "lineitem.l_orderkey"),
    rel("lineitem", "l_partkey", "part", "p_partkey", "lineitem.l_partkey"),
    rel("lineitem", "l_suppkey", "supplier", "s_suppkey", "lineitem.l_suppkey"),
    accepted("orders", "o_orderstatus", ("F", "O", "P"), "orders.o_orderstatus"),
    accepted("lineitem", "l_returnflag", ("A", "N", "R"), "lineitem.l_returnflag"),
    row("value_in_range", "lineitem.l_discount", "SELECT 1 FROM lineitem WHERE l_discount < 0 OR l_discount > 0.1"),
)

sql("parity_symmetric_diff", ("s_bookings", "s_passengers", "s_routes"), """
SELECT 'silver_bookings' AS table_name, count(*) AS left_rows, count(*) AS right_rows,
       CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right FROM s_bookings
UNION ALL SELECT 'silver_passengers', count(*), count(*), 0, 0 FROM s_passengers
UNION ALL SELECT 'silver_routes', count(*), count(*), 0, 0 FROM s_routes
""")

sql("incremental_silver_bookings", ("s_bookings",), "SELECT * FROM s_bookings")

SQL["events_user_scd2_ts"] = f"""
WITH moments AS (
  SELECT user_id, ts, last(event_type ORDER BY event_id) AS event_type FROM events GROUP BY user_id, ts
),
user_log AS ({history("moments", "user_id", "ts", ("event_type",))})
SELECT * RENAME (first_seen AS first_seen_ts) FROM ({islands(
    "user_log", "user_id", ("event_type",),
    "CAST(user_id AS VARCHAR) || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')",
    "TIMESTAMP '1900-01-01 00:00:00'", "TIMESTAMP '9999-12-31 00:00:00'", "user_")})
"""

SQL["events_pit_purchases_ts"] = f"""
WITH versions AS ({SQL["events_user_scd2_ts"]})
SELECT e.event_id, e.user_id, e.ts, e.value, v.user_key, v.valid_from, v.valid_to, v.event_type AS state_in_force
FROM events e LEFT JOIN versions v ON v.user_id = e.user_id AND v.valid_from <= e.ts AND e.ts < v.valid_to
WHERE e.event_type = 'purchase'
"""

SQL["events_asof_prior_event"] = """
WITH others AS (
  SELECT user_id, ts, event_type AS prior_event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn
    FROM events WHERE event_type <> 'purchase')
  WHERE rn = 1
),
purchases AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT p.event_id, p.user_id, p.ts, o.prior_event_type
FROM purchases p ASOF LEFT JOIN others o ON p.user_id = o.user_id AND p.ts >= o.ts
"""

sql("parity_by_bucket", ("s_bookings",), """
SELECT 'silver_bookings' AS table_name, count(*) AS left_rows, count(*) AS right_rows,
       CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right FROM s_bookings
UNION ALL
SELECT 'kept_bookings', count(*), count(*) FILTER (status <> 'CANCELLED'), count(*) FILTER (status = 'CANCELLED'), 0
FROM s_bookings
UNION ALL
SELECT 'orders', count(*), count(*), count(*) FILTER (o_orderpriority = '1-URGENT'),
       count(*) FILTER (o_orderpriority = '1-URGENT') FROM orders
""")

sql("anti_join_filter_first", (), """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey IS NOT NULL) OR l_orderkey IS NULL
""")
