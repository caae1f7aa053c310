"""Silver layer for the booking domain: cleanse -> classify -> {silver, quarantine, metrics}.

Every function returns a lazy DataFrame; nothing here triggers a job. ``SilverInputs`` bundles the
three landing extracts so the same plan runs on landing views derived from the driver tables, on
CSV files read back from disk, or on a streaming micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.accounting import account_by_key, identity_by_key, row_count_metric
from ..operators.classify import MissingAny, Negative, NotAccepted, NotInReference, Present, accepted, classify, quarantine
from ..operators.cleanse import ColumnSpec, cleanse
from ..operators.dedupe import dedupe_latest
from ..sources.landing import (
    BOOKING_COLUMNS,
    PASSENGER_COLUMNS,
    landing_bookings,
    landing_passengers,
    landing_routes,
)

# The booking domain and the order in which reject reasons are applied.
BOOKING_STATUSES = ("CONFIRMED", "CANCELLED", "CHECKED_IN", "FLOWN")
LOYALTY_TIERS = ("NONE", "BLUE", "SILVER", "GOLD")

ROUTE_SPEC = (
    ColumnSpec("route_code", blank_to_null=False, case="upper"),
    ColumnSpec("origin", blank_to_null=False, case="upper"),
    ColumnSpec("destination", blank_to_null=False, case="upper"),
    ColumnSpec("distance_miles", blank_to_null=False, cast="int"),
)
BOOKING_SPEC = (
    ColumnSpec("booking_id"),
    ColumnSpec("passenger_id"),
    ColumnSpec("route_code", case="upper"),
    ColumnSpec("booking_ts", cast="timestamp_ntz"),
    ColumnSpec("travel_date", cast="date"),
    ColumnSpec("fare_amount", cast="decimal(10,2)"),
    ColumnSpec("currency", case="upper"),
    ColumnSpec("status", case="upper"),
    ColumnSpec("channel", case="upper"),
    ColumnSpec("updated_ts", cast="timestamp_ntz"),
)
PASSENGER_SPEC = (
    ColumnSpec("passenger_id"),
    ColumnSpec("full_name", blank_to_null=False),
    ColumnSpec("email", blank_to_null=False, case="lower"),
    ColumnSpec("loyalty_tier", blank_to_null=False, case="upper"),
    ColumnSpec("home_airport", blank_to_null=False, case="upper"),
    ColumnSpec("updated_at", cast="date"),
)

#: Column of an extract that holds the whole line of a row with too many or too few fields, where the reader keeps it.
RECORD = "malformed_line"

BOOKING_KEY = ("booking_id",)
BOOKING_ORDER = (("updated_ts", True), ("load_date", True))
PASSENGER_KEY = ("passenger_id", "updated_at")
PASSENGER_ORDER = (("load_date", True),)

SILVER_BOOKING_COLUMNS = [
    "booking_id", "passenger_id", "route_code", "booking_ts", "booking_date", "travel_date",
    "fare_amount", "currency", "status", "channel", "updated_ts", "load_date",
]
SILVER_PASSENGER_COLUMNS = [*PASSENGER_COLUMNS, "load_date"]


@dataclass(frozen=True)
class SilverInputs:
    routes: DataFrame
    bookings: DataFrame
    passengers: DataFrame


def landing_inputs(spark: SparkSession, sf_dir: str) -> SilverInputs:
    return SilverInputs(
        routes=landing_routes(spark, sf_dir),
        bookings=landing_bookings(spark, sf_dir),
        passengers=landing_passengers(spark, sf_dir),
    )


def kept_columns(df: DataFrame) -> list[str]:
    """Columns that pass through cleansing and quarantine as they are."""
    return ["load_date", *([RECORD] if RECORD in df.columns else [])]


def with_record_rule(df: DataFrame, rules):
    """``rules``, led by that for malformed lines where ``df`` keeps them: their values are not to be trusted."""
    return (Present("malformed_line", column=RECORD), *rules) if RECORD in df.columns else tuple(rules)


# ---------------------------------------------------------------------------------------- routes
def silver_routes(inputs: SilverInputs) -> DataFrame:
    """Routes are reference data: normalised, never quarantined or de-duplicated."""
    return cleanse(inputs.routes, ROUTE_SPEC, raw=False)


# -------------------------------------------------------------------------------------- bookings
def cleanse_bookings(inputs: SilverInputs) -> DataFrame:
    return cleanse(inputs.bookings, BOOKING_SPEC, keep=kept_columns(inputs.bookings))


def booking_rules(routes: DataFrame):
    return (
        MissingAny("malformed_value", columns=("booking_id", "booking_ts", "travel_date", "fare_amount", "updated_ts")),
        MissingAny("missing_passenger_id", columns=("passenger_id",)),
        Negative("negative_fare", column="fare_amount"),
        NotAccepted("invalid_status", column="status", values=BOOKING_STATUSES),
        NotInReference("unknown_route", column="route_code", reference=routes, ref_column="route_code"),
    )


def classify_bookings(inputs: SilverInputs) -> DataFrame:
    cleansed = cleanse_bookings(inputs)
    return classify(cleansed, with_record_rule(cleansed, booking_rules(silver_routes(inputs))))


def dedupe_bookings(classified: DataFrame) -> DataFrame:
    stored = accepted(classified).select(*[c for c in SILVER_BOOKING_COLUMNS if c != "booking_date"])
    latest = dedupe_latest(stored, BOOKING_KEY, BOOKING_ORDER)
    return latest.withColumn("booking_date", F.to_date("booking_ts")).select(*SILVER_BOOKING_COLUMNS)


def silver_bookings(inputs: SilverInputs) -> DataFrame:
    return dedupe_bookings(classify_bookings(inputs))


def quarantine_bookings(inputs: SilverInputs) -> DataFrame:
    return quarantine(classify_bookings(inputs), BOOKING_COLUMNS, keep=kept_columns(inputs.bookings))


# ------------------------------------------------------------------------------------ passengers
PASSENGER_RULES = (
    MissingAny("malformed_value", columns=("updated_at",)),
    MissingAny("missing_passenger_id", columns=("passenger_id",)),
    NotAccepted("invalid_loyalty_tier", column="loyalty_tier", values=LOYALTY_TIERS),
)


def cleanse_passengers(inputs: SilverInputs) -> DataFrame:
    return cleanse(inputs.passengers, PASSENGER_SPEC, keep=kept_columns(inputs.passengers))


def classify_passengers(inputs: SilverInputs) -> DataFrame:
    cleansed = cleanse_passengers(inputs)
    return classify(cleansed, with_record_rule(cleansed, PASSENGER_RULES))


def dedupe_passengers(classified: DataFrame) -> DataFrame:
    stored = accepted(classified).select(*SILVER_PASSENGER_COLUMNS)
    return dedupe_latest(stored, PASSENGER_KEY, PASSENGER_ORDER)


def silver_passengers(inputs: SilverInputs) -> DataFrame:
    return dedupe_passengers(classify_passengers(inputs))


def quarantine_passengers(inputs: SilverInputs) -> DataFrame:
    return quarantine(classify_passengers(inputs), PASSENGER_COLUMNS, keep=kept_columns(inputs.passengers))


# ------------------------------------------------------------------------------------- accounting
def accounting_metrics(inputs: SilverInputs) -> DataFrame:
    """Long-form metrics of all three datasets (the reference's nested metrics dict, flattened)."""
    return (
        row_count_metric("routes", "silver_rows", silver_routes(inputs))
        .unionByName(account_by_key("bookings", classify_bookings(inputs), BOOKING_KEY))
        .unionByName(account_by_key("passengers", classify_passengers(inputs), PASSENGER_KEY))
    )


def accounting_identity(inputs: SilverInputs) -> DataFrame:
    bookings = identity_by_key("bookings", classify_bookings(inputs), BOOKING_KEY)
    return bookings.unionByName(identity_by_key("passengers", classify_passengers(inputs), PASSENGER_KEY))
