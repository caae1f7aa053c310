"""Oracle SQL per registered query (DuckDB dialect over the driver views)."""

from __future__ import annotations

from .fragments import DEC, INT, ISO, with_ctes

SQL: dict[str, str] = {}


def sql(name: str, needed: tuple[str, ...], select: str) -> None:
    SQL[name] = with_ctes(needed, select)


TYPED_B = (
    "booking_id, passenger_id, route_code, booking_ts, travel_date, fare_amount, currency, status, "
    "channel, updated_ts, load_date"
)
RAW_B = (
    "raw_booking_id, raw_passenger_id, raw_route_code, raw_booking_ts, raw_travel_date, raw_fare_amount, "
    "raw_currency, raw_status, raw_channel, raw_updated_ts"
)
TYPED_P = "passenger_id, full_name, email, loyalty_tier, home_airport, updated_at, load_date"

# ------------------------------------------------------------------------------------ silver
sql("cleanse_bookings", ("b_parsed",), "SELECT * FROM b_parsed")
sql("cleanse_passengers", ("p_parsed",), "SELECT * FROM p_parsed")
sql("cleanse_routes", ("s_routes",), "SELECT * FROM s_routes")
sql("silver_routes", ("s_routes",), "SELECT * FROM s_routes")
sql("classify_bookings", ("b_classified",), f"SELECT {TYPED_B}, reject_reason FROM b_classified")
sql("classify_passengers", ("p_classified",), f"SELECT {TYPED_P}, reject_reason FROM p_classified")
sql("rejects_by_reason", ("b_classified", "p_classified"), """
SELECT 'bookings' AS dataset, reject_reason, count(*) AS rejected
FROM b_classified WHERE reject_reason IS NOT NULL GROUP BY reject_reason
UNION ALL
SELECT 'passengers', reject_reason, count(*)
FROM p_classified WHERE reject_reason IS NOT NULL GROUP BY reject_reason
""")
sql("quarantine_bookings", ("b_classified",), """
SELECT raw_booking_id AS booking_id, raw_passenger_id AS passenger_id, raw_route_code AS route_code,
       raw_booking_ts AS booking_ts, raw_travel_date AS travel_date, raw_fare_amount AS fare_amount,
       raw_currency AS currency, raw_status AS status, raw_channel AS channel,
       raw_updated_ts AS updated_ts, load_date, reject_reason
FROM b_classified WHERE reject_reason IS NOT NULL
""")
sql("quarantine_passengers", ("p_classified",), """
SELECT raw_passenger_id AS passenger_id, raw_full_name AS full_name, raw_email AS email,
       raw_loyalty_tier AS loyalty_tier, raw_home_airport AS home_airport,
       raw_updated_at AS updated_at, load_date, reject_reason
FROM p_classified WHERE reject_reason IS NOT NULL
""")
sql("silver_bookings", ("s_bookings",), "SELECT * FROM s_bookings")
sql("silver_passengers", ("s_passengers",), "SELECT * FROM s_passengers")
sql("dedupe_latest_bookings", ("b_ranked",), "SELECT booking_id, updated_ts, load_date, status FROM b_ranked WHERE rn = 1")
sql("dedupe_latest_passengers", ("p_ranked",),
    "SELECT passenger_id, updated_at, load_date, loyalty_tier FROM p_ranked WHERE rn = 1")

_METRICS = """
SELECT '{ds}' AS dataset, m.metric, CAST(NULL AS VARCHAR) AS reason, m.value
FROM (
  SELECT
    (SELECT count(*) FROM {cls}) AS landing_rows,
    (SELECT count(*) FROM {silver}) AS silver_rows,
    (SELECT count(*) FROM {cls} WHERE reject_reason IS NOT NULL) AS rejected,
    (SELECT count(*) FROM {cls} WHERE reject_reason IS NULL) - (SELECT count(*) FROM {silver}) AS duplicates_removed
) t,
LATERAL (VALUES ('landing_rows', t.landing_rows), ('silver_rows', t.silver_rows),
                ('rejected', t.rejected), ('duplicates_removed', t.duplicates_removed)) AS m(metric, value)
UNION ALL
SELECT '{ds}', 'rejected_by_reason', reject_reason, count(*)
FROM {cls} WHERE reject_reason IS NOT NULL GROUP BY reject_reason
"""
sql("accounting_metrics", ("s_routes", "b_classified", "s_bookings", "p_classified", "s_passengers"),
    "SELECT 'routes' AS dataset, 'silver_rows' AS metric, CAST(NULL AS VARCHAR) AS reason, count(*) AS value "
    "FROM s_routes\nUNION ALL\n"
    + _METRICS.format(ds="bookings", cls="b_classified", silver="s_bookings")
    + "UNION ALL\n"
    + _METRICS.format(ds="passengers", cls="p_classified", silver="s_passengers"))

_IDENTITY = """
SELECT '{ds}' AS dataset, landing_rows, silver_rows, rejected, duplicates_removed,
       landing_rows = silver_rows + rejected + duplicates_removed AS balanced
FROM (
  SELECT
    (SELECT count(*) FROM {cls}) AS landing_rows,
    (SELECT count(*) FROM {silver}) AS silver_rows,
    (SELECT count(*) FROM {cls} WHERE reject_reason IS NOT NULL) AS rejected,
    (SELECT count(*) FROM {cls} WHERE reject_reason IS NULL) - (SELECT count(*) FROM {silver}) AS duplicates_removed
)
"""
sql("accounting_identity", ("b_classified", "s_bookings", "p_classified", "s_passengers"),
    _IDENTITY.format(ds="bookings", cls="b_classified", silver="s_bookings")
    + "UNION ALL\n"
    + _IDENTITY.format(ds="passengers", cls="p_classified", silver="s_passengers"))

sql("anti_join_unknown_route", ("b_parsed", "s_routes"), """
SELECT booking_id, route_code, load_date FROM b_parsed b
WHERE route_code IS NOT NULL
  AND route_code NOT IN (SELECT route_code FROM s_routes WHERE route_code IS NOT NULL)
""")


def _cast_rows(src: str, column: str, spark_type: str, pattern: str, duck_type: str) -> str:
    v = f"NULLIF(trim({column}), '')"
    return (
        f"SELECT '{column}' AS column_name, '{spark_type}' AS target_type, {column} AS raw_value, "
        f"CAST(CASE WHEN regexp_matches({v}, '{pattern}') THEN TRY_CAST({v} AS {duck_type}) END AS VARCHAR) "
        f"AS cast_value FROM {src}"
    )


sql("try_cast_matrix", ("l_bookings", "l_passengers", "l_routes"), "SELECT DISTINCT * FROM (\n" + "\nUNION ALL\n".join([
    _cast_rows("l_bookings", "booking_ts", "timestamp_ntz", ISO, "TIMESTAMP"),
    _cast_rows("l_bookings", "travel_date", "date", ISO, "DATE"),
    _cast_rows("l_bookings", "fare_amount", "decimal(10,2)", DEC, "DECIMAL(10, 2)"),
    _cast_rows("l_bookings", "updated_ts", "timestamp_ntz", ISO, "TIMESTAMP"),
    _cast_rows("l_passengers", "updated_at", "date", ISO, "DATE"),
    _cast_rows("l_routes", "distance_miles", "int", INT, "INTEGER"),
]) + "\n)")
