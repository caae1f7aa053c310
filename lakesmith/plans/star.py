"""Star schema over silver: staging views, dim_date, dim_route, dim_passenger (SCD2), the
point-in-time fact and the two marts. All lazy.

Join strategy: no join here carries a broadcast hint. Dimension sides are broadcast by the planner
only when their estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` (and by AQE when
their runtime size is), otherwise the join is a sort-merge join on the key; AQE splits skewed keys
(for example the unknown member ``-1``, which may carry a large share of all facts).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY, date_key, surrogate_key
from ..operators.dims import bucket, calendar_bounds, date_spine, dim_date, unknown_member
from ..operators.pit import point_in_time_join
from ..operators.scd2 import OPEN_END, OPEN_START, scd2
from . import silver as S

PASSENGER_TRACKED = ("full_name", "email", "loyalty_tier", "home_airport")
# Route length buckets (miles, exclusive upper bounds) and unknown members.
ROUTE_TYPES = ((500, "SHORT"), (1200, "MEDIUM"))
ROUTE_TYPE_ELSE = "LONG"
UNKNOWN_ROUTE = {
    "route_key": UNKNOWN_KEY, "route_code": "UNKNOWN", "origin": "UNKNOWN", "destination": "UNKNOWN",
    "distance_miles": None, "route_type": "UNKNOWN",
}
UNKNOWN_PASSENGER = {
    "passenger_key": UNKNOWN_KEY, "passenger_id": "UNKNOWN", "full_name": "Unknown", "email": None,
    "loyalty_tier": "UNKNOWN", "home_airport": "UNKNOWN", "first_seen_date": OPEN_START,
    "valid_from": OPEN_START, "valid_to": OPEN_END, "is_current": True,
}


# ------------------------------------------------------------------------------------- staging
def stg_bookings(silver_bookings: DataFrame) -> DataFrame:
    return silver_bookings.select(
        "booking_id", "passenger_id", "route_code",
        F.col("booking_ts").cast("timestamp_ntz").alias("booking_ts"),
        F.col("booking_date").cast("date").alias("booking_date"),
        F.col("travel_date").cast("date").alias("travel_date"),
        F.col("fare_amount").cast("decimal(10,2)").alias("fare_amount"),
        "currency", "status", "channel",
        F.col("updated_ts").cast("timestamp_ntz").alias("updated_ts"),
    )


def stg_passengers(silver_passengers: DataFrame) -> DataFrame:
    return silver_passengers.select(
        "passenger_id", "full_name", "email", "loyalty_tier", "home_airport",
        F.col("updated_at").cast("date").alias("updated_at"),
    )


def stg_routes(silver_routes: DataFrame) -> DataFrame:
    return silver_routes.select(
        "route_code", "origin", "destination", F.col("distance_miles").cast("int").alias("distance_miles")
    )


# ---------------------------------------------------------------------------------- dimensions
def booking_calendar(stg_b: DataFrame) -> DataFrame:
    return dim_date(date_spine(calendar_bounds(stg_b, ["booking_date", "travel_date"])))


def build_dim_route(stg_r: DataFrame) -> DataFrame:
    dim = stg_r.select(
        surrogate_key("route_code").alias("route_key"),
        "route_code", "origin", "destination", "distance_miles",
        bucket(F.col("distance_miles"), ROUTE_TYPES, ROUTE_TYPE_ELSE).alias("route_type"),
    )
    return unknown_member(dim, UNKNOWN_ROUTE)


def passenger_versions(stg_p: DataFrame) -> DataFrame:
    return scd2(
        stg_p, key=["passenger_id"], tracked=list(PASSENGER_TRACKED), version="updated_at",
        surrogate="passenger_key", first_seen="first_seen_date",
    )


def build_dim_passenger(stg_p: DataFrame) -> DataFrame:
    return unknown_member(passenger_versions(stg_p), UNKNOWN_PASSENGER)


# ---------------------------------------------------------------------------------------- fact
def build_fact_bookings(stg_b: DataFrame, versions: DataFrame, dim_r: DataFrame) -> DataFrame:
    """Grain: one row per booking; passenger version resolved at the booking date.

    ``versions`` are the passenger versions *without* the unknown member: a booking that matches
    no version gets ``-1`` from the coalesce, exactly as a match on the unknown member would. The
    join salts its keys, so a passenger with a large share of all bookings is split.
    """
    versions = versions.where(F.col("passenger_key") != UNKNOWN_KEY).select(
        F.col("passenger_key"), F.col("passenger_id").alias("__pid"), "valid_from", "valid_to"
    )
    routes = dim_r.select("route_key", F.col("route_code").alias("__rcode"))
    b = point_in_time_join(stg_b, versions, "passenger_id", "booking_date", "__pid")
    b = b.join(routes, b["route_code"] == routes["__rcode"], "left")
    return b.select(
        "booking_id",
        F.coalesce("passenger_key", F.lit(UNKNOWN_KEY)).alias("passenger_key"),
        F.coalesce("route_key", F.lit(UNKNOWN_KEY)).alias("route_key"),
        date_key("booking_date").alias("booking_date_key"),
        date_key("travel_date").alias("travel_date_key"),
        "fare_amount", "currency", "status", "channel",
        (F.col("status") == "CANCELLED").alias("is_cancelled"),
        F.datediff("travel_date", "booking_date").cast("bigint").alias("days_to_travel"),
        "updated_ts",
    )


# --------------------------------------------------------------------------------------- marts
def _revenue(fare: str = "fare_amount") -> F.Column:
    """Sum of non-cancelled fares; NULL (not 0) when every booking of the group is cancelled."""
    return F.sum(F.when(~F.col("is_cancelled"), F.col(fare))).cast("decimal(38,2)")


def build_mart_daily_route_revenue(fact: DataFrame, dates: DataFrame, dim_r: DataFrame) -> DataFrame:
    d = dates.select("date_key", F.col("date_day").alias("travel_date"), "day_name")
    j = fact.join(d, fact["travel_date_key"] == d["date_key"]).join(dim_r, "route_key")
    n = F.count(F.lit(1))
    cancelled = F.count_if(F.col("is_cancelled"))
    return j.groupBy("travel_date", "day_name", "route_code", "origin", "destination", "route_type").agg(
        n.alias("bookings"),
        cancelled.alias("cancelled_bookings"),
        F.round(cancelled.cast("double") / n, 4).alias("cancellation_rate"),
        _revenue().alias("gross_revenue"),
        F.round(F.avg("days_to_travel"), 1).alias("avg_days_to_travel"),
    )


def build_mart_revenue_by_loyalty_tier(fact: DataFrame, dim_p: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue by the tier held at booking time (the fact already points at that version)."""
    p = dim_p.select("passenger_key", "passenger_id", "loyalty_tier")
    d = dates.select("date_key", F.col("date_day").alias("booking_date"))
    j = fact.join(p, "passenger_key").join(d, fact["booking_date_key"] == d["date_key"])
    return j.groupBy("booking_date", "loyalty_tier").agg(
        F.count(F.lit(1)).alias("bookings"),
        F.count_distinct("passenger_id").alias("passengers"),
        _revenue().alias("gross_revenue"),
    )


# ---------------------------------------------------------------------------------------- bundle
@dataclass(frozen=True)
class Star:
    stg_bookings: DataFrame
    stg_passengers: DataFrame
    stg_routes: DataFrame
    dim_date: DataFrame
    dim_route: DataFrame
    dim_passenger: DataFrame
    fact_bookings: DataFrame
    mart_daily_route_revenue: DataFrame
    mart_revenue_by_loyalty_tier: DataFrame


def build_star(stg_b: DataFrame, stg_p: DataFrame, stg_r: DataFrame) -> Star:
    dates = booking_calendar(stg_b)
    dim_r = build_dim_route(stg_r)
    versions = passenger_versions(stg_p)
    dim_p = unknown_member(versions, UNKNOWN_PASSENGER)
    fact = build_fact_bookings(stg_b, versions, dim_r)
    return Star(
        stg_bookings=stg_b,
        stg_passengers=stg_p,
        stg_routes=stg_r,
        dim_date=dates,
        dim_route=dim_r,
        dim_passenger=dim_p,
        fact_bookings=fact,
        mart_daily_route_revenue=build_mart_daily_route_revenue(fact, dates, dim_r),
        mart_revenue_by_loyalty_tier=build_mart_revenue_by_loyalty_tier(fact, dim_p, dates),
    )


def star_from_silver(inputs: S.SilverInputs) -> Star:
    return build_star(
        stg_bookings(S.silver_bookings(inputs)),
        stg_passengers(S.silver_passengers(inputs)),
        stg_routes(S.silver_routes(inputs)),
    )


def materialized_star(stg_b: DataFrame, stg_p: DataFrame, stg_r: DataFrame) -> Star:
    """The star with every shared table written once to the shared scratch folder and read back
    (for suites that read each table many times, such as the data-quality checks)."""
    from ..session import materialize

    stg_b, stg_p = materialize(stg_b, "stg-bookings"), materialize(stg_p, "stg-passengers")
    stg_r = materialize(stg_r, "stg-routes")
    dates = materialize(booking_calendar(stg_b), "dim-date")
    dim_r = materialize(build_dim_route(stg_r), "dim-route")
    dim_p = materialize(build_dim_passenger(stg_p), "dim-passenger")
    fact = materialize(build_fact_bookings(stg_b, dim_p, dim_r), "fact-bookings")
    return Star(
        stg_bookings=stg_b,
        stg_passengers=stg_p,
        stg_routes=stg_r,
        dim_date=dates,
        dim_route=dim_r,
        dim_passenger=dim_p,
        fact_bookings=fact,
        mart_daily_route_revenue=materialize(build_mart_daily_route_revenue(fact, dates, dim_r), "mart-route"),
        mart_revenue_by_loyalty_tier=materialize(build_mart_revenue_by_loyalty_tier(fact, dim_p, dates), "mart-tier"),
    )


class LazyStar:
    """The star with each table built and written to the shared scratch folder on first use (at
    most once), so a single check writes only the tables it reads. Attribute names match
    :class:`Star`."""

    def __init__(self, stg_b: DataFrame, stg_p: DataFrame, stg_r: DataFrame):
        self._raw = {"stg_bookings": stg_b, "stg_passengers": stg_p}
        self.stg_routes = stg_r  # tiny, read once (by dim_route)
        self._done: dict[str, DataFrame] = {}

    def _table(self, name: str, build) -> DataFrame:
        if name not in self._done:
            from ..session import materialize

            self._done[name] = materialize(build(), name.replace("_", "-"))
        return self._done[name]

    @property
    def stg_bookings(self) -> DataFrame:
        return self._table("stg_bookings", lambda: self._raw["stg_bookings"])

    @property
    def stg_passengers(self) -> DataFrame:
        return self._table("stg_passengers", lambda: self._raw["stg_passengers"])

    @property
    def dim_date(self) -> DataFrame:
        return self._table("dim_date", lambda: booking_calendar(self.stg_bookings))

    @property
    def dim_route(self) -> DataFrame:
        return self._table("dim_route", lambda: build_dim_route(self.stg_routes))

    @property
    def dim_passenger(self) -> DataFrame:
        return self._table("dim_passenger", lambda: build_dim_passenger(self.stg_passengers))

    @property
    def fact_bookings(self) -> DataFrame:
        return self._table(
            "fact_bookings", lambda: build_fact_bookings(self.stg_bookings, self.dim_passenger, self.dim_route)
        )

    @property
    def mart_daily_route_revenue(self) -> DataFrame:
        return self._table(
            "mart_daily_route_revenue",
            lambda: build_mart_daily_route_revenue(self.fact_bookings, self.dim_date, self.dim_route),
        )

    @property
    def mart_revenue_by_loyalty_tier(self) -> DataFrame:
        return self._table(
            "mart_revenue_by_loyalty_tier",
            lambda: build_mart_revenue_by_loyalty_tier(self.fact_bookings, self.dim_passenger, self.dim_date),
        )
