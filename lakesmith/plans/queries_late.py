"""Registered queries of late loads: the tables after all loads equal a rebuild."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .late_loads import run_late_loads
from .registry import query


@query("incremental_dim_passenger")
def q_incremental_dim_passenger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passenger dimension after loads in reverse order of their dates."""
    return run_late_loads(spark, sf_dir).dimension()


@query("incremental_fact_bookings")
def q_incremental_fact_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after the same loads, re-resolved only where another version is in force."""
    return run_late_loads(spark, sf_dir).fact()


@query("incremental_mart_loyalty_tier")
def q_incremental_mart_loyalty_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tier mart after the same loads, from signed rows."""
    return run_late_loads(spark, sf_dir).mart()
