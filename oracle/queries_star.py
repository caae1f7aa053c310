"""Oracle SQL of the star-schema queries."""

from __future__ import annotations

from .queries import sql

sql("stg_bookings", ("stg_b",), "SELECT * FROM stg_b")
sql("stg_passengers", ("stg_p",), "SELECT * FROM stg_p")
sql("stg_routes", ("stg_r",), "SELECT * FROM stg_r")
sql("dim_date", ("d_date",), "SELECT * FROM d_date")
sql("dim_route", ("d_route",), "SELECT * FROM d_route")
sql("dim_passenger_scd2", ("d_pass",), "SELECT * FROM d_pass")
sql("scd2_change_detection", ("p_hist",), "SELECT passenger_id, updated_at, version_no, is_change FROM p_hist")
sql("scd2_first_seen", ("p_hist",), "SELECT passenger_id, updated_at, first_seen_date FROM p_hist")
sql("surrogate_key_md5", ("p_versions", "stg_r"), """
SELECT 'dim_passenger' AS dimension, passenger_id || '|' || strftime(valid_from, '%Y-%m-%d') AS natural_key,
       passenger_key AS surrogate_key
FROM p_versions
UNION ALL
SELECT 'dim_route', route_code, md5(route_code) FROM stg_r
""")
sql("fact_bookings", ("f_book",), "SELECT * FROM f_book")
sql("pit_join_fact", ("b_state",), """
SELECT booking_id, passenger_id, booking_date, passenger_key, valid_from, valid_to, loyalty_tier FROM b_state
""")
sql("mart_daily_route_revenue", ("m_route",), "SELECT * FROM m_route")
sql("mart_revenue_by_loyalty_tier", ("m_tier",), "SELECT * FROM m_tier")
sql("unknown_member_bookings", ("f_book",), """
SELECT count(*) AS fact_rows,
       count(*) FILTER (WHERE passenger_key = '-1') AS unknown_member_bookings,
       CAST(sum(fare_amount) FILTER (WHERE passenger_key = '-1') AS DECIMAL(38, 2)) AS unknown_member_fare
FROM f_book
""")
sql("scd2_version_summary", ("p_versions",), """
SELECT passenger_id, len(opens) AS versions, opens[1] AS first_valid_from, list_max(closes) AS last_valid_to,
       current_versions, opens[2:] = closes[:len(closes) - 1] AS contiguous
FROM (
  SELECT passenger_id, list(valid_from ORDER BY valid_from) AS opens, list(valid_to ORDER BY valid_from) AS closes,
         CAST(sum(CAST(is_current AS INTEGER)) AS BIGINT) AS current_versions
  FROM p_versions GROUP BY passenger_id)
""")
sql("pit_recompute_arg_max", ("exp_tier", "f_book", "d_pass"), """
SELECT f.booking_id, f.passenger_key, e.tier AS expected_tier, p.loyalty_tier AS resolved_tier
FROM f_book f
JOIN d_pass p ON p.passenger_key = f.passenger_key
JOIN exp_tier e ON e.booking_id = f.booking_id
""")
sql("order_by_all", ("d_route",), "SELECT * FROM d_route ORDER BY ALL")
sql("filter_between_in", ("f_book",), """
SELECT status, count(*) AS bookings, CAST(sum(fare_amount) AS DECIMAL(38, 2)) AS fare
FROM f_book
WHERE booking_date_key BETWEEN 19960101 AND 19981231 AND status IN ('CANCELLED', 'FLOWN')
GROUP BY status
""")
sql("incremental_dim_passenger", ("d_pass",), "SELECT * FROM d_pass")
sql("incremental_fact_bookings", ("f_book",), "SELECT * FROM f_book")
sql("incremental_mart_loyalty_tier", ("m_tier",), "SELECT * FROM m_tier")
