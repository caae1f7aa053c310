"""Registered queries: native bindings on the driver tables and the table-parity report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.membership import filtered_anti_join
from ..operators.parity import bucketed_difference, symmetric_difference
from ..session import scratch_path
from ..sources.files import read_text_csv, write_text_csv
from ..sources.landing import BOOKING_COLUMNS, PASSENGER_COLUMNS, ROUTE_COLUMNS
from ..sources.tables import table
from . import native as N
from . import silver as S
from .registry import query

for _name, _fn in [
    ("events_latest_per_user_type", N.events_latest_per_user_type),
    ("events_user_scd2", N.user_state_scd2),
    ("events_user_scd2_ts", N.user_state_scd2_ts),
    ("events_pit_purchases", N.purchases_in_force),
    ("events_pit_purchases_ts", N.purchases_in_force_ts),
    ("events_asof_prior_event", N.purchases_prior_event),
    ("lineitem_ship_mart", N.lineitem_ship_mart),
    ("dq_tpch", N.dq_tpch),
]:
    query(_name)(_fn)


def csv_extract_inputs(spark: SparkSession, sf_dir: str) -> S.SilverInputs:
    """The landing extracts as they arrive in production: CSV folders (``load_date=D/`` for the
    daily extracts), read back as text."""
    direct = S.landing_inputs(spark, sf_dir)
    paths = {n: scratch_path(spark, f"extract-{n}") for n in ("routes", "bookings", "passengers")}
    write_text_csv(direct.routes, paths["routes"])
    write_text_csv(direct.bookings, paths["bookings"], partition_columns=["load_date"])
    write_text_csv(direct.passengers, paths["passengers"], partition_columns=["load_date"])
    return S.SilverInputs(
        routes=read_text_csv(spark, paths["routes"], ROUTE_COLUMNS),
        bookings=read_text_csv(spark, paths["bookings"], BOOKING_COLUMNS, ["load_date"]),
        passengers=read_text_csv(spark, paths["passengers"], PASSENGER_COLUMNS, ["load_date"]),
    )


@query("parity_symmetric_diff")
def q_parity_symmetric_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver built from CSV extracts versus silver built from the in-memory landing views:
    both directions of the multiset difference must be empty for every table."""
    direct = S.landing_inputs(spark, sf_dir)
    extract = csv_extract_inputs(spark, sf_dir)
    parts = [
        symmetric_difference(S.silver_bookings(extract), S.silver_bookings(direct), "silver_bookings"),
        symmetric_difference(S.silver_passengers(extract), S.silver_passengers(direct), "silver_passengers"),
        symmetric_difference(S.silver_routes(extract), S.silver_routes(direct), "silver_routes"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("parity_by_bucket")
def q_parity_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parity by bucket sums: silver bookings against themselves from CSV (equal) and without their cancelled ones, and
    orders against orders whose urgent ones have another priority."""
    direct = S.silver_bookings(S.landing_inputs(spark, sf_dir))
    extract = S.silver_bookings(csv_extract_inputs(spark, sf_dir))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    lowered = F.when(F.col("o_orderpriority") == "1-URGENT", "2-HIGH").otherwise(F.col("o_orderpriority"))
    return (
        bucketed_difference(extract, direct, "silver_bookings")
        .unionByName(bucketed_difference(direct, direct.where("status <> 'CANCELLED'"), "kept_bookings"))
        .unionByName(bucketed_difference(orders, orders.withColumn("o_orderpriority", lowered), "orders"))
    )


@query("anti_join_filter_first")
def q_anti_join_filter_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of orders that are not urgent: most are told apart by a filter of the urgent orders' keys, without a shuffle."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    return filtered_anti_join(items, urgent, [("l_orderkey", "o_orderkey")])
