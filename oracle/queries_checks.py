"""Oracle SQL of the data-quality queries (offending-row queries, counted)."""

from __future__ import annotations

from .fragments import frag
from .queries import sql


def row(check: str, target: str, offending: str) -> str:
    return f"SELECT '{check}' AS check_name, '{target}' AS target, (SELECT count(*) FROM ({offending})) AS violations"


def unique(rel: str, col: str, target: str) -> str:
    return row("unique", target, f"SELECT {col} FROM {rel} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1")


def not_null(rel: str, col: str, target: str) -> str:
    return row("not_null", target, f"SELECT 1 FROM {rel} WHERE {col} IS NULL")


def accepted(rel: str, col: str, values: tuple[str, ...], target: str) -> str:
    vals = ", ".join(f"'{v}'" for v in values)
    return row("accepted_values", target, f"SELECT {col} FROM {rel} WHERE {col} NOT IN ({vals}) GROUP BY {col}")


def rel(child: str, col: str, parent: str, pcol: str, target: str) -> str:
    return row("relationships", target,
               f"SELECT c.{col} FROM {child} c LEFT JOIN {parent} p ON c.{col} = p.{pcol} "
               f"WHERE c.{col} IS NOT NULL AND p.{pcol} IS NULL")


def union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


TIERS = ("NONE", "BLUE", "SILVER", "GOLD")
STATUSES = ("CONFIRMED", "CANCELLED", "CHECKED_IN", "FLOWN")
STAR = ("stg_b", "stg_p", "d_date", "d_route", "d_pass", "f_book", "m_route", "m_tier")

CHECKS: dict[str, str] = {}
CHECKS["dq_unique"] = union(
    unique("stg_b", "booking_id", "stg_bookings.booking_id"),
    unique("d_date", "date_key", "dim_date.date_key"),
    unique("d_route", "route_key", "dim_route.route_key"),
    unique("d_pass", "passenger_key", "dim_passenger.passenger_key"),
    unique("f_book", "booking_id", "fact_bookings.booking_id"),
)
CHECKS["dq_not_null"] = union(
    not_null("stg_b", "booking_id", "stg_bookings.booking_id"),
    not_null("stg_b", "fare_amount", "stg_bookings.fare_amount"),
    not_null("stg_p", "passenger_id", "stg_passengers.passenger_id"),
    not_null("d_date", "date_key", "dim_date.date_key"),
    not_null("d_route", "route_key", "dim_route.route_key"),
    not_null("d_pass", "passenger_key", "dim_passenger.passenger_key"),
    not_null("d_pass", "valid_from", "dim_passenger.valid_from"),
    not_null("d_pass", "valid_to", "dim_passenger.valid_to"),
    not_null("f_book", "booking_id", "fact_bookings.booking_id"),
    not_null("f_book", "passenger_key", "fact_bookings.passenger_key"),
    not_null("f_book", "route_key", "fact_bookings.route_key"),
)
CHECKS["dq_accepted_values"] = union(
    accepted("stg_p", "loyalty_tier", TIERS, "stg_passengers.loyalty_tier"),
    accepted("d_route", "route_type", ("SHORT", "MEDIUM", "LONG", "UNKNOWN"), "dim_route.route_type"),
    accepted("d_pass", "loyalty_tier", (*TIERS, "UNKNOWN"), "dim_passenger.loyalty_tier"),
    accepted("f_book", "status", STATUSES, "fact_bookings.status"),
)
CHECKS["dq_relationships"] = union(
    rel("f_book", "passenger_key", "d_pass", "passenger_key", "fact_bookings.passenger_key"),
    rel("f_book", "route_key", "d_route", "route_key", "fact_bookings.route_key"),
    rel("f_book", "booking_date_key", "d_date", "date_key", "fact_bookings.booking_date_key"),
    rel("f_book", "travel_date_key", "d_date", "date_key", "fact_bookings.travel_date_key"),
)
CHECKS["dq_value_in_range"] = row(
    "value_in_range", "mart_daily_route_revenue.cancellation_rate",
    "SELECT cancellation_rate FROM m_route WHERE cancellation_rate < 0 OR cancellation_rate > 1",
)
CHECKS["dq_fact_reconciles"] = row("fact_reconciles_to_silver", "fact_bookings", """
SELECT count(*), sum(fare_amount) FROM f_book EXCEPT SELECT count(*), sum(fare_amount) FROM stg_b""")
CHECKS["dq_known_keys_resolve"] = row("known_passengers_resolve_to_a_version", "fact_bookings", """
SELECT booking_id FROM f_book WHERE passenger_key = '-1'
INTERSECT SELECT booking_id FROM stg_b SEMI JOIN stg_p USING (passenger_id)""")
CHECKS["dq_one_current_version"] = row("one_current_version_per_passenger", "dim_passenger", """
SELECT passenger_id FROM d_pass GROUP BY passenger_id HAVING sum(CAST(is_current AS INTEGER)) > 1""")
# each window's start meets the windows of its passenger that are open at that moment
CHECKS["dq_scd2_overlap"] = union("""
SELECT 'no_overlapping_windows' AS check_name, 'dim_passenger' AS target,
       CAST(coalesce(sum(open_before) FILTER (WHERE step = 1), 0) AS BIGINT) AS violations
FROM (
  SELECT step, sum(step) OVER (PARTITION BY passenger_id ORDER BY moment, step
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_before
  FROM (SELECT passenger_id, unnest([1, -1]) AS step, unnest([valid_from, valid_to]) AS moment
        FROM d_pass WHERE valid_from < valid_to))""",
    row("proper_windows", "dim_passenger", "SELECT 1 FROM d_pass WHERE valid_to - valid_from <= 0"),
)
CHECKS["dq_pit_containment"] = row("point_in_time_containment", "fact_bookings", """
SELECT booking_id, passenger_key FROM f_book WHERE passenger_key <> '-1'
EXCEPT
SELECT booking_id, passenger_key FROM stg_b JOIN d_pass USING (passenger_id)
WHERE booking_date BETWEEN valid_from AND valid_to - 1""")
CHECKS["dq_tier_recompute"] = row("tier_equals_recomputation", "fact_bookings", """
SELECT booking_id, loyalty_tier FROM f_book SEMI JOIN (SELECT booking_id FROM exp_tier WHERE tier IS NOT NULL) USING (booking_id)
  JOIN d_pass USING (passenger_key)
EXCEPT SELECT booking_id, tier FROM exp_tier""")
_TOTALS = {
    "f_book": "SELECT count(*) AS n, sum(if(is_cancelled, NULL, fare_amount)) AS g FROM f_book",
    "mart": "SELECT sum(bookings) AS n, sum(gross_revenue) AS g FROM {mart}",
}
CHECKS["dq_marts_reconcile"] = (
    "SELECT 'marts_reconcile_to_fact' AS check_name, 'marts' AS target, count(*) AS violations FROM ("
    + "\nUNION ALL\n".join(
        f"(SELECT {c} FROM ({_TOTALS['mart'].format(mart=m)}) EXCEPT SELECT {c} FROM ({_TOTALS['f_book']}))"
        for m in ("m_route", "m_tier")
        for c in ("n", "g")
    )
    + ")"
)
CHECKS["dq_silver_valid"] = union(
    row("silver_rows_valid", "stg_bookings", f"""
SELECT booking_id FROM stg_b
EXCEPT ALL
SELECT booking_id FROM stg_b SEMI JOIN (SELECT unnest({list(STATUSES)}) AS status) USING (status)
WHERE fare_amount >= 0 AND passenger_id IS NOT NULL"""),
    row("silver_text_clean", "stg_passengers", """
SELECT email, full_name FROM stg_p WHERE email IS NOT NULL AND full_name IS NOT NULL
EXCEPT ALL SELECT lower(trim(email)), trim(full_name) FROM stg_p"""),
)
CHECKS["dq_contiguous_versions"] = row("contiguous_versions", "dim_passenger", """
SELECT passenger_id FROM (
  SELECT passenger_id, list(valid_from ORDER BY valid_from) AS opens, list(valid_to ORDER BY valid_from) AS closes,
         count(nullif(is_current, false)) AS n
  FROM d_pass WHERE passenger_key <> '-1' GROUP BY passenger_id)
WHERE n <> 1 OR [DATE '1900-01-01'] || closes <> opens || [DATE '9999-12-31']""")

frag("dq_all", STAR + ("exp_tier",), "\nUNION ALL\n".join(f"SELECT * FROM ({CHECKS[k]})" for k in CHECKS))

for _name, _body in CHECKS.items():
    sql(_name, STAR + ("exp_tier",), _body)
sql("dq_summary", ("dq_all",), "SELECT * FROM dq_all")
