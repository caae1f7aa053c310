"""Registered source/sink queries: CSV and Parquet round trips, idempotent rebuild, metrics sink.

Each query writes below a fresh path in the session's shared scratch folder (``spark.checkpoint.dir``)
and returns the DataFrame read back from it.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.accounting import account_by_key, row_count_metric
from ..operators.classify import quarantine
from ..session import materialize, scratch_path
from ..sources.files import read_parquet, read_text_csv, write_parquet, write_text_csv
from ..sources.landing import BOOKING_COLUMNS, ROUTE_COLUMNS, booking_lines
from . import silver as S
from . import star as T
from . import warehouse as W
from .registry import query


@query("csv_scan_partitioned")
def q_csv_scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing bookings written as ``load_date=D/`` CSV folders, scanned back as all-text."""
    path = scratch_path(spark, "landing-bookings-csv")
    write_text_csv(S.landing_inputs(spark, sf_dir).bookings, path, partition_columns=["load_date"])
    return read_text_csv(spark, path, BOOKING_COLUMNS, partition_columns=["load_date"])


@query("csv_scan_flat")
def q_csv_scan_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing-routes-csv")
    write_text_csv(S.landing_inputs(spark, sf_dir).routes, path)
    return read_text_csv(spark, path, ROUTE_COLUMNS)


@query("parquet_roundtrip")
def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model materialised as a Parquet table (dim_route) and read back."""
    inputs = S.landing_inputs(spark, sf_dir)
    path = scratch_path(spark, "dim-route")
    write_parquet(T.build_dim_route(T.stg_routes(S.silver_routes(inputs))), path)
    return read_parquet(spark, path)


@query("parquet_partition_roundtrip")
def q_parquet_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver bookings Hive-partitioned by booking_date, read back with partition discovery."""
    path = scratch_path(spark, "silver-bookings")
    write_parquet(
        S.silver_bookings(S.landing_inputs(spark, sf_dir)), path,
        partition_columns=["booking_date"], cluster_by=["booking_id"],
    )
    back = read_parquet(spark, path)
    return back.withColumn("booking_date", F.col("booking_date").cast("date"))


@query("idempotent_rebuild")
def q_idempotent_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver built twice into the same root; the metrics JSON and table counts read back after
    the second build must equal a single build's."""
    inputs = S.landing_inputs(spark, sf_dir)
    root = scratch_path(spark, "silver-root")
    W.build_silver(spark, inputs, root)
    paths, (silver_b, silver_p, routes) = W.build_silver(spark, inputs, root)
    # the opened silver frames already hold the listing of the second build's files
    counts = [
        row_count_metric("bookings", "written_silver_rows", silver_b),
        row_count_metric("bookings", "written_quarantine_rows", read_parquet(spark, paths.quarantine_bookings)),
        row_count_metric("passengers", "written_silver_rows", silver_p),
        row_count_metric("passengers", "written_quarantine_rows", read_parquet(spark, paths.quarantine_passengers)),
        row_count_metric("routes", "written_silver_rows", routes),
    ]
    out = W.read_metrics_json(spark, paths.metrics)
    for c in counts:
        out = out.unionByName(c)
    return out


@query("observed_metrics")
def q_observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounting of one silver build, as its writes observed it; no pass of its own reads the tables for it."""
    paths, _ = W.build_silver(spark, S.landing_inputs(spark, sf_dir), scratch_path(spark, "observed-silver"))
    return W.read_metrics_json(spark, paths.metrics)


def _malformed_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing bookings written as lines of which some are too wide or too short, read back and classified, staged once."""
    inputs = S.landing_inputs(spark, sf_dir)
    path = scratch_path(spark, "landing-booking-lines")
    booking_lines(inputs.bookings).write.partitionBy("load_date").text(path)
    read = read_text_csv(spark, path, BOOKING_COLUMNS, ["load_date"], record_column=S.RECORD, header=False)
    return materialize(S.classify_bookings(replace(inputs, bookings=read)), "classified-lines")


@query("malformed_bookings")
def q_malformed_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine lane of malformed lines: each whole line, as it arrived."""
    rejected = quarantine(_malformed_classified(spark, sf_dir), BOOKING_COLUMNS, keep=("load_date", S.RECORD))
    return rejected.where(F.col(S.RECORD).isNotNull()).select(S.RECORD, "load_date", "reject_reason")


@query("malformed_accounting")
def q_malformed_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounting of an extract with malformed lines: each line is silver, rejected or a removed duplicate."""
    return account_by_key("bookings", _malformed_classified(spark, sf_dir), S.BOOKING_KEY)


@query("catalog_star")
def q_catalog_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star published under catalog names and read by them in SQL: bookings and revenue by route type and tier."""
    database = f"lakesmith_{uuid.uuid4().hex[:12]}"
    W.publish(spark, S.landing_inputs(spark, sf_dir), scratch_path(spark, "catalog-root"), database=database)
    return spark.sql(f"""
        SELECT r.route_type, p.loyalty_tier, d.year, count(*) AS bookings,
               count_if(f.is_cancelled) AS cancelled_bookings,
               sum(CASE WHEN NOT f.is_cancelled THEN f.fare_amount END) AS gross_revenue
        FROM {database}.fact_bookings f
        JOIN {database}.dim_route r ON r.route_key = f.route_key
        JOIN {database}.dim_passenger p ON p.passenger_key = f.passenger_key
        JOIN {database}.dim_date d ON d.date_key = f.travel_date_key
        GROUP BY r.route_type, p.loyalty_tier, d.year
    """).withColumn("gross_revenue", F.col("gross_revenue").cast("decimal(38,2)"))
