"""Oracle SQL of the source/sink round-trip queries."""

from __future__ import annotations

from .fragments import frag
from .queries import SQL, sql

sql("csv_scan_partitioned", ("l_bookings",), "SELECT * FROM l_bookings")
sql("csv_scan_flat", ("l_routes",), "SELECT * FROM l_routes")
sql("parquet_roundtrip", ("d_route",), "SELECT * FROM d_route")
sql("parquet_partition_roundtrip", ("s_bookings",), "SELECT * FROM s_bookings")

# what the writes observe is what the tables hold
SQL["observed_metrics"] = SQL["accounting_metrics"]

# the metrics read back after two builds equal one build's metrics, plus the written table counts
SQL["idempotent_rebuild"] = (
    SQL["accounting_metrics"].rstrip()
    + """
UNION ALL SELECT 'bookings', 'written_silver_rows', NULL, (SELECT count(*) FROM s_bookings)
UNION ALL SELECT 'bookings', 'written_quarantine_rows', NULL,
                 (SELECT count(*) FROM b_classified WHERE reject_reason IS NOT NULL)
UNION ALL SELECT 'passengers', 'written_silver_rows', NULL, (SELECT count(*) FROM s_passengers)
UNION ALL SELECT 'passengers', 'written_quarantine_rows', NULL,
                 (SELECT count(*) FROM p_classified WHERE reject_reason IS NOT NULL)
UNION ALL SELECT 'routes', 'written_silver_rows', NULL, (SELECT count(*) FROM s_routes)"""
)

# bookings as lines: every 89th number (remainder 13) has a field too many, the next (14) its first four fields alone
frag("line_rows", ("b_classified",), """
SELECT *, TRY_CAST(substr(raw_booking_id, 2) AS BIGINT) % 89 AS residue,
       concat_ws(',', raw_booking_id, raw_passenger_id, raw_route_code, raw_booking_ts) AS first_four,
       concat_ws(',', raw_travel_date, if(contains(raw_fare_amount, ','), '"' || raw_fare_amount || '"', raw_fare_amount),
                 raw_currency, raw_status, raw_channel, raw_updated_ts) AS last_six
FROM b_classified
""")
frag("line_reasons", ("line_rows",), """
SELECT booking_id, if(residue IN (13, 14), 'malformed_line', reject_reason) AS reason FROM line_rows
""")
sql("malformed_bookings", ("line_rows",), """
SELECT first_four || ',' || last_six || ',surplus' AS malformed_line, load_date, 'malformed_line' AS reject_reason
FROM line_rows WHERE residue = 13
UNION ALL
SELECT first_four, load_date, 'malformed_line' FROM line_rows WHERE residue = 14
""")
sql("malformed_accounting", ("line_reasons",), """
SELECT 'bookings' AS dataset, 'landing_rows' AS metric, CAST(NULL AS VARCHAR) AS reason, count(*) AS value FROM line_reasons
UNION ALL
SELECT 'bookings', 'silver_rows', NULL, count(DISTINCT booking_id) FROM line_reasons WHERE reason IS NULL
UNION ALL
SELECT 'bookings', 'rejected', NULL, count(*) FROM line_reasons WHERE reason IS NOT NULL
UNION ALL
SELECT 'bookings', 'duplicates_removed', NULL, count(*) - count(DISTINCT booking_id) FROM line_reasons WHERE reason IS NULL
UNION ALL
SELECT 'bookings', 'rejected_by_reason', reason, count(*) FROM line_reasons WHERE reason IS NOT NULL GROUP BY reason
""")

sql("catalog_star", ("b_state", "d_route"), """
SELECT r.route_type, ifnull(b.loyalty_tier, 'UNKNOWN') AS loyalty_tier, CAST(year(b.travel_date) AS INTEGER) AS year,
       count(*) AS bookings, count(*) FILTER (b.status = 'CANCELLED') AS cancelled_bookings,
       CAST(sum(b.fare_amount) FILTER (b.status <> 'CANCELLED') AS DECIMAL(38, 2)) AS gross_revenue
FROM b_state b JOIN d_route r USING (route_code)
GROUP BY 1, 2, 3
""")
