"""Registered queries of the star schema (staging, dimensions, SCD2, point-in-time fact, marts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY
from ..operators.pit import interval_merge_join
from ..operators.scd2 import change_detection
from . import silver as S
from . import star as T
from .registry import query


def _star(spark: SparkSession, sf_dir: str) -> T.Star:
    return T.star_from_silver(S.landing_inputs(spark, sf_dir))


def _stg(spark: SparkSession, sf_dir: str):
    inputs = S.landing_inputs(spark, sf_dir)
    return (
        T.stg_bookings(S.silver_bookings(inputs)),
        T.stg_passengers(S.silver_passengers(inputs)),
        T.stg_routes(S.silver_routes(inputs)),
    )


@query("stg_bookings")
def q_stg_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stg(spark, sf_dir)[0]


@query("stg_passengers")
def q_stg_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stg(spark, sf_dir)[1]


@query("stg_routes")
def q_stg_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stg(spark, sf_dir)[2]


@query("dim_date")
def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over whole years of the booking and travel dates present in silver."""
    return T.booking_calendar(_stg(spark, sf_dir)[0])


@query("dim_route")
def q_dim_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.build_dim_route(_stg(spark, sf_dir)[2])


@query("dim_passenger_scd2")
def q_dim_passenger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.build_dim_passenger(_stg(spark, sf_dir)[1])


@query("scd2_change_detection")
def q_scd2_change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    cd = change_detection(_stg(spark, sf_dir)[1], ["passenger_id"], list(T.PASSENGER_TRACKED), "updated_at")
    return cd.select("passenger_id", "updated_at", "version_no", "is_change")


@query("scd2_first_seen")
def q_scd2_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    cd = change_detection(_stg(spark, sf_dir)[1], ["passenger_id"], list(T.PASSENGER_TRACKED), "updated_at")
    return cd.select("passenger_id", "updated_at", F.col("first_seen").alias("first_seen_date"))


@query("surrogate_key_md5")
def q_surrogate_key_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every surrogate key with the natural key it hashes (passenger versions and routes)."""
    _, stg_p, stg_r = _stg(spark, sf_dir)
    p = T.passenger_versions(stg_p).select(
        F.lit("dim_passenger").alias("dimension"),
        F.concat_ws("|", "passenger_id", F.date_format("valid_from", "yyyy-MM-dd")).alias("natural_key"),
        F.col("passenger_key").alias("surrogate_key"),
    )
    r = T.build_dim_route(stg_r).where(F.col("route_key") != UNKNOWN_KEY).select(
        F.lit("dim_route").alias("dimension"), F.col("route_code").alias("natural_key"),
        F.col("route_key").alias("surrogate_key"),
    )
    return p.unionByName(r)


@query("fact_bookings")
def q_fact_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).fact_bookings


@query("pit_join_fact")
def q_pit_join_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw point-in-time join: each booking with the passenger version valid on its date."""
    stg_b, stg_p, _ = _stg(spark, sf_dir)
    versions = T.passenger_versions(stg_p).select(
        "passenger_key", F.col("passenger_id").alias("v_passenger_id"), "valid_from", "valid_to", "loyalty_tier"
    )
    j = interval_merge_join(
        stg_b.select("booking_id", "passenger_id", "booking_date"), versions,
        "passenger_id", "booking_date", "v_passenger_id",
    )
    return j.select("booking_id", "passenger_id", "booking_date", "passenger_key", "valid_from", "valid_to", "loyalty_tier")


@query("mart_daily_route_revenue")
def q_mart_daily_route_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).mart_daily_route_revenue


@query("mart_revenue_by_loyalty_tier")
def q_mart_revenue_by_loyalty_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).mart_revenue_by_loyalty_tier


@query("unknown_member_bookings")
def q_unknown_member_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late-arriving passengers: bookings kept on the unknown member, counted (not dropped)."""
    f = _star(spark, sf_dir).fact_bookings
    on_unknown = F.col("passenger_key") == UNKNOWN_KEY
    return f.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(on_unknown).alias("unknown_member_bookings"),
        F.sum(F.when(on_unknown, F.col("fare_amount"))).cast("decimal(38,2)").alias("unknown_member_fare"),
    )


@query("scd2_version_summary")
def q_scd2_version_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per passenger: versions, first valid_from, last valid_to, current versions, contiguity."""
    from pyspark.sql import Window

    v = T.passenger_versions(_stg(spark, sf_dir)[1])
    w = Window.partitionBy("passenger_id").orderBy("valid_from")
    gaps = v.withColumn("__next_from", F.lead("valid_from").over(w)).withColumn(
        "__joined", F.col("__next_from").isNull() | (F.col("__next_from") == F.col("valid_to"))
    )
    return gaps.groupBy("passenger_id").agg(
        F.count(F.lit(1)).alias("versions"),
        F.min("valid_from").alias("first_valid_from"),
        F.max("valid_to").alias("last_valid_to"),
        F.count_if("is_current").alias("current_versions"),
        F.bool_and("__joined").alias("contiguous"),
    )


@query("pit_recompute_arg_max")
def q_pit_recompute_arg_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Independent recomputation of the tier in force at booking time (as-of lookup on the raw
    staging history) next to the tier the fact resolved through the SCD2 windows."""
    from .quality import tier_recompute

    return tier_recompute(_star(spark, sf_dir))


@query("order_by_all")
def q_order_by_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension listing sorted by every column (range-partitioned global sort)."""
    d = T.build_dim_route(_stg(spark, sf_dir)[2])
    return d.orderBy(*[F.col(c).asc_nulls_last() for c in d.columns])


@query("filter_between_in")
def q_filter_between_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BETWEEN on a date range and IN on a status list over the fact (the predicates themselves
    are the feature); both reach the fact's Filter before the aggregate."""
    f = _star(spark, sf_dir).fact_bookings
    return (
        f.where(F.col("booking_date_key").between(19960101, 19981231))
        .where(F.col("status").isin("CANCELLED", "FLOWN"))
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("bookings"), F.sum("fare_amount").cast("decimal(38,2)").alias("fare"))
    )

