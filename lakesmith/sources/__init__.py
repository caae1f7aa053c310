from .files import read_parquet, read_text_csv, text_schema, write_parquet, write_text_csv
from .landing import (
    BOOKING_COLUMNS,
    PASSENGER_COLUMNS,
    ROUTE_COLUMNS,
    landing_bookings,
    landing_passengers,
    landing_routes,
)
from .tables import DRIVER_TABLES, table

__all__ = [
    "BOOKING_COLUMNS",
    "DRIVER_TABLES",
    "PASSENGER_COLUMNS",
    "ROUTE_COLUMNS",
    "landing_bookings",
    "landing_passengers",
    "landing_routes",
    "read_parquet",
    "read_text_csv",
    "table",
    "text_schema",
    "write_parquet",
    "write_text_csv",
]
