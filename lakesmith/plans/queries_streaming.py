"""Registered streaming query: silver bookings maintained incrementally, one load at a time."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.files import write_parquet
from ..streaming.incremental import start_incremental_bookings
from . import silver as S
from .registry import query


def run_incremental(spark: SparkSession, sf_dir: str) -> str:
    """Deliver the landing bookings as two daily CSV folders, one after the other, and let the
    stream merge each into silver. Returns the silver path."""
    inputs = S.landing_inputs(spark, sf_dir)
    root = scratch_path(spark, "incremental")
    routes_path = os.path.join(root, "silver", "routes")
    write_parquet(S.silver_routes(inputs), routes_path)
    landing = os.path.join(root, "landing", "bookings")
    loads = [r["load_date"] for r in inputs.bookings.select("load_date").distinct().orderBy("load_date").collect()]
    for load in loads:  # one small row per load folder (the loads present), not data
        (
            inputs.bookings.where(F.col("load_date") == load).drop("load_date")
            .write.mode("overwrite").option("header", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(os.path.join(landing, f"load_date={load}"))
        )
        q = start_incremental_bookings(
            spark, landing, routes_path, os.path.join(root, "silver", "bookings"),
            os.path.join(root, "quarantine", "bookings"), os.path.join(root, "_checkpoint"),
        )
        q.awaitTermination()
    return os.path.join(root, "silver", "bookings")


@query("incremental_silver_bookings")
def q_incremental_silver_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_incremental(spark, sf_dir)
    df = spark.read.parquet(path)
    return df.select(*S.SILVER_BOOKING_COLUMNS).withColumn("booking_date", F.col("booking_date").cast("date"))
