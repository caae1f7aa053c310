"""Registered queries of the silver layer (cleanse, classify, quarantine, dedupe, accounting)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classify import accepted, rejects_by_reason
from ..operators.dedupe import dedupe_latest
from ..operators.cleanse import RAW_PREFIX
from . import silver as S
from .registry import query


def _inputs(spark: SparkSession, sf_dir: str) -> S.SilverInputs:
    return S.landing_inputs(spark, sf_dir)


def _typed(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith(RAW_PREFIX)])


@query("cleanse_bookings")
def q_cleanse_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.cleanse_bookings(_inputs(spark, sf_dir))


@query("cleanse_passengers")
def q_cleanse_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.cleanse_passengers(_inputs(spark, sf_dir))


@query("cleanse_routes")
def q_cleanse_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.silver_routes(_inputs(spark, sf_dir))


@query("classify_bookings")
def q_classify_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(S.classify_bookings(_inputs(spark, sf_dir)))


@query("classify_passengers")
def q_classify_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(S.classify_passengers(_inputs(spark, sf_dir)))


@query("rejects_by_reason")
def q_rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = _inputs(spark, sf_dir)
    b = rejects_by_reason(S.classify_bookings(inputs)).select(F.lit("bookings").alias("dataset"), "*")
    p = rejects_by_reason(S.classify_passengers(inputs)).select(F.lit("passengers").alias("dataset"), "*")
    return b.unionByName(p).select("dataset", "reject_reason", F.col("rejected").cast("bigint"))


@query("quarantine_bookings")
def q_quarantine_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.quarantine_bookings(_inputs(spark, sf_dir))


@query("quarantine_passengers")
def q_quarantine_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.quarantine_passengers(_inputs(spark, sf_dir))


@query("silver_bookings")
def q_silver_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.silver_bookings(_inputs(spark, sf_dir))


@query("silver_passengers")
def q_silver_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.silver_passengers(_inputs(spark, sf_dir))


@query("silver_routes")
def q_silver_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.silver_routes(_inputs(spark, sf_dir))


@query("dedupe_latest_bookings")
def q_dedupe_latest_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winning version per booking_id with its order columns (generic operator, bookings spec)."""
    acc = accepted(S.classify_bookings(_inputs(spark, sf_dir)))
    return dedupe_latest(acc, S.BOOKING_KEY, S.BOOKING_ORDER).select("booking_id", "updated_ts", "load_date", "status")


@query("dedupe_latest_passengers")
def q_dedupe_latest_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    acc = accepted(S.classify_passengers(_inputs(spark, sf_dir)))
    return dedupe_latest(acc, S.PASSENGER_KEY, S.PASSENGER_ORDER).select(
        "passenger_id", "updated_at", "load_date", "loyalty_tier"
    )


@query("accounting_metrics")
def q_accounting_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.accounting_metrics(_inputs(spark, sf_dir))


@query("accounting_identity")
def q_accounting_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.accounting_identity(_inputs(spark, sf_dir))


@query("anti_join_unknown_route")
def q_anti_join_unknown_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleansed bookings whose route code is absent from the (NULL-free) route reference."""
    inputs = _inputs(spark, sf_dir)
    routes = S.silver_routes(inputs).select("route_code").where(F.col("route_code").isNotNull())
    bookings = _typed(S.cleanse_bookings(inputs)).where(F.col("route_code").isNotNull())
    return bookings.join(routes, "route_code", "left_anti").select("booking_id", "route_code", "load_date")


@query("try_cast_matrix")
def q_try_cast_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct landing text of the castable columns with its guarded-cast result as text."""
    inputs = _inputs(spark, sf_dir)
    from ..functions.text import blank_to_null, guarded_cast

    def cast_rows(df: DataFrame, types: dict[str, str]) -> DataFrame:
        cells = [
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(type_name).alias("target_type"),
                F.col(column).alias("raw_value"),
                guarded_cast(blank_to_null(column), type_name).cast("string").alias("cast_value"),
            )
            for column, type_name in types.items()
        ]
        return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")

    parts = [
        cast_rows(inputs.bookings, {"booking_ts": "timestamp_ntz", "travel_date": "date",
                                    "fare_amount": "decimal(10,2)", "updated_ts": "timestamp_ntz"}),
        cast_rows(inputs.passengers, {"updated_at": "date"}),
        cast_rows(inputs.routes, {"distance_miles": "int"}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
