"""The same operators bound to the driver's own tables (no landing views): events, lineitem,
orders/customer/part/supplier.

* latest event per (user, event type)                      -- dedupe_latest
* daily user state history -> SCD2 of the user's event type -- dedupe_latest + scd2 (date grain,
  so a user's window group is bounded by the number of days, however many events the user has)
* purchases resolved to the user state in force that day    -- point_in_time_join
* shipping mart: lineitem x part x calendar                 -- calendar + joins + conditional aggs
* TPC-H referential / domain checks                          -- checks library
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY, date_key
from ..operators import checks as C
from ..operators.dedupe import dedupe_latest
from ..operators.dims import calendar_bounds, date_spine, dim_date
from ..operators.pit import asof_lookup_ranged, interval_merge_join, point_in_time_join
import datetime as dt

from ..operators.scd2 import scd2, scd2_ranged
from ..sources.tables import table

# TPC-H domains.
ORDER_STATUSES = ("F", "O", "P")
RETURN_FLAGS = ("A", "N", "R")


def events_latest_per_user_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return dedupe_latest(e, ["user_id", "event_type"], [("ts", True), ("event_id", True)])


def user_daily_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user, day): the type of the user's last event that day."""
    e = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts", F.to_date("ts").alias("snapshot_date")
    )
    latest = dedupe_latest(e, ["user_id", "snapshot_date"], [("ts", True), ("event_id", True)])
    return latest.select("user_id", "snapshot_date", "event_type")


def user_state_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2(
        user_daily_state(spark, sf_dir), key=["user_id"], tracked=["event_type"], version="snapshot_date",
        surrogate="user_key", first_seen="first_seen_date",
    )


def user_state_scd2_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD2 of each user's event type at event-time grain. A user's history is unbounded here (a
    single user may own a third of all events), so the skew-safe range-partitioned variant is
    used instead of per-user windows."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    history = dedupe_latest(e, ["user_id", "ts"], [("event_id", True)]).select("user_id", "event_type", "ts")
    return scd2_ranged(
        history, key=["user_id"], tracked=["event_type"], version="ts", surrogate="user_key",
        first_seen="first_seen_ts", open_start=dt.datetime(1900, 1, 1), open_end=dt.datetime(9999, 12, 31),
        version_text=lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    )


def purchases_prior_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the type of the user's latest non-purchase event at or before it
    (as-of at event-time grain, so the range-partitioned lookup is used)."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    purchases = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    others = dedupe_latest(
        e.where(F.col("event_type") != "purchase"), ["user_id", "ts"], [("event_id", True)]
    ).select("user_id", "ts", F.col("event_type").alias("prior_event_type"))
    return asof_lookup_ranged(purchases, others, ["user_id"], "ts", "ts", ["prior_event_type"], prefix="")


def purchases_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = user_state_scd2(spark, sf_dir).select(
        "user_key", F.col("user_id").alias("__uid"), "valid_from", "valid_to", F.col("event_type").alias("state_in_force")
    )
    purchases = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select("event_id", "user_id", F.to_date("ts").alias("purchase_date"), "value")
    )
    j = point_in_time_join(purchases, versions, "user_id", "purchase_date", "__uid")
    return j.select(
        "event_id", "user_id", "purchase_date",
        F.coalesce("user_key", F.lit(UNKNOWN_KEY)).alias("user_key"), "state_in_force",
    )


def purchases_in_force_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's version in force at its instant. Versions are of event-time grain, so a user
    may have any number of them, and of purchases: the join is a forward sweep."""
    versions = user_state_scd2_ts(spark, sf_dir).select(
        "user_key", F.col("user_id").alias("__uid"), "valid_from", "valid_to", F.col("event_type").alias("state_in_force")
    )
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    purchases = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    j = interval_merge_join(purchases, versions, "user_id", "ts", "__uid")
    return j.select("event_id", "user_id", "ts", "value", "user_key", "valid_from", "valid_to", "state_in_force")


def lineitem_ship_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
        F.to_date("l_shipdate").alias("ship_date"),
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    cal = dim_date(date_spine(calendar_bounds(li, ["ship_date"]))).select("date_key", "date_day", "day_name")
    j = (
        li.withColumn("ship_date_key", date_key("ship_date"))
        .join(part, li["l_partkey"] == part["p_partkey"])
        .join(cal, F.col("ship_date_key") == cal["date_key"])
    )
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    disc = F.col("l_discount").cast("decimal(15,2)")
    returned = F.col("l_returnflag") == "R"
    n = F.count(F.lit(1))
    return j.groupBy(F.col("date_day").alias("ship_date"), "day_name", "p_brand").agg(
        n.alias("lines"),
        F.count_if(returned).alias("returned_lines"),
        F.round(F.count_if(returned).cast("double") / n, 4).alias("return_rate"),
        F.sum(F.when(~returned, price * (F.lit(1) - disc))).cast("decimal(38,4)").alias("net_revenue"),
        F.round(F.avg("l_quantity"), 1).alias("avg_quantity"),
    )


def dq_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    li = table(spark, sf_dir, "lineitem")
    return C.union_checks([
        C.unique(o, "o_orderkey", "orders.o_orderkey"),
        C.unique(c, "c_custkey", "customer.c_custkey"),
        C.not_null(li, "l_orderkey", "lineitem.l_orderkey"),
        C.not_null(o, "o_custkey", "orders.o_custkey"),
        C.relationships(o, "o_custkey", c, "c_custkey", "orders.o_custkey"),
        C.relationships(li, "l_orderkey", o, "o_orderkey", "lineitem.l_orderkey"),
        C.relationships(li, "l_partkey", table(spark, sf_dir, "part"), "p_partkey", "lineitem.l_partkey"),
        C.relationships(li, "l_suppkey", table(spark, sf_dir, "supplier"), "s_suppkey", "lineitem.l_suppkey"),
        C.accepted_values(o, "o_orderstatus", ORDER_STATUSES, "orders.o_orderstatus"),
        C.accepted_values(li, "l_returnflag", RETURN_FLAGS, "lineitem.l_returnflag"),
        C.value_in_range(li, "l_discount", 0, 0.1, "lineitem.l_discount"),
    ])
