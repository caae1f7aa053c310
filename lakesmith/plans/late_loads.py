"""Late passenger loads: dimension, fact and tier mart kept up to date without rebuilding them.

The tables below ``root`` are Parquet, dealt by what a load touches:

* ``history`` (silver passengers) and ``dimension`` (passenger versions) by ``slice``, a hash of the passenger;
* ``fact`` by ``month`` of the booking;
* ``tier_state`` by ``month``: the tier mart as sums per (day, tier, passenger), so that its distinct passengers can go down.

A load is merged in steps: its accepted rows join the history of their slices; the touched passengers' versions are rebuilt and
compared with the stored ones; the bookings inside the changed segments get their new key, in their months alone; and the mart's state
takes the signed rows of those whose tier or passenger changed. Each step first stages its new partitions below ``_work``, by the
number of the load, and then overwrites only those (dynamic partition overwrite). What is staged is a redo log: a merge that
is called again after a crash takes staged rows as they are, so that none of its steps reads a table it has changed already. Untouched
partitions' files stay as they are. Any order of loads, repeated ones too, gives the tables of a full rebuild.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY
from ..operators.classify import classify
from ..operators.cleanse import cleanse
from ..operators.dedupe import dedupe_latest
from ..operators.dims import unknown_member
from ..operators.scd2_merge import merged_versions, narrowed, reresolved, signed, summed
from ..sources.files import slice_count
from . import silver as S
from . import star as T

SLICES = 32


def _slice() -> Column:
    return F.pmod(F.xxhash64("passenger_id"), F.lit(SLICES)).cast("int").alias("slice")


def _month(date: str) -> Column:
    return F.date_format(date, "yyyyMM").cast("int").alias("month")


class LateLoads:
    """The tables below ``root`` over fixed silver bookings and routes, and the merge of passenger loads."""

    def __init__(self, spark: SparkSession, root: str, stg_bookings: DataFrame, dim_route: DataFrame):
        self.spark, self.root, self.dim_route = spark, root, dim_route
        self.loads = 0
        self._write(stg_bookings.withColumn("month", _month("booking_date")), "bookings", "month")

    def _at(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        """The rows of a step of this load, written once."""
        path = self._at("_work", f"{name}-{self.loads}")
        done = self.spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
        if not done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _write(self, df: DataFrame, table: str, by: str) -> DataFrame:
        """Stage the partitions that ``df`` has, then put them in place of the table's; the staged rows."""
        rows = self._stage(df, table)
        out = rows.repartitionByRange(slice_count(rows), by, *[c for c in rows.columns if c != by][:1])
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(self._at(table))
        return rows

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self._at(table))

    def _parts(self, rows: DataFrame, by: str) -> list[int]:
        """The partitions that rows touch: at most as many as the table has."""
        return sorted(r[0] for r in rows.select(by).distinct().collect())

    def dimension(self) -> DataFrame:
        return unknown_member(self.read("dimension").drop("slice"), T.UNKNOWN_PASSENGER)

    def fact(self) -> DataFrame:
        return self.read("fact").drop("month")

    def mart(self) -> DataFrame:
        """The tier mart from its state."""
        kept = F.sum("kept")
        return self.read("tier_state").groupBy("booking_date", "loyalty_tier").agg(
            F.sum("bookings").alias("bookings"),
            F.count_if(F.col("bookings") > 0).alias("passengers"),
            F.when(kept > 0, F.sum("revenue")).cast("decimal(38,2)").alias("gross_revenue"),
        )

    def first(self, silver_passengers: DataFrame) -> None:
        """Everything from scratch for the first load."""
        silver = silver_passengers.withColumn("updated_at", F.col("updated_at").cast("date"))
        history = self._write(silver.withColumn("slice", _slice()), "history", "slice")
        versions = self._write(T.passenger_versions(T.stg_passengers(history)).withColumn("slice", _slice()), "dimension", "slice")
        bookings = self.read("bookings")
        fact = T.build_fact_bookings(bookings.drop("month"), versions.drop("slice"), self.dim_route)
        fact = self._write(fact.withColumn("month", F.floor(F.col("booking_date_key") / 100).cast("int")), "fact", "month")
        tiers = unknown_member(versions.drop("slice"), T.UNKNOWN_PASSENGER).select("passenger_key", "passenger_id", "loyalty_tier")
        rows = fact.join(tiers, "passenger_key").withColumn("booking_date", F.to_date(F.col("booking_date_key").cast("string"), "yyyyMMdd"))
        rows = rows.select("booking_date", "loyalty_tier", "passenger_id", *_measures())
        state = summed(None, rows, ["booking_date", "loyalty_tier", "passenger_id"])
        self._write(state.withColumn("month", _month("booking_date")), "tier_state", "month")
        self.loads += 1

    def merge(self, landed: DataFrame) -> dict[str, list[int]]:
        """One more load of raw passenger rows; the partitions of each table that it changed."""
        load = S.dedupe_passengers(classify(cleanse(landed, S.PASSENGER_SPEC, keep=["load_date"]), S.PASSENGER_RULES))
        load = self._stage(load.withColumn("updated_at", F.col("updated_at").cast("date")).withColumn("slice", _slice()), "load")
        slices = self._parts(load, "slice")
        if not slices:
            self.loads += 1
            return {}
        near = self.read("history").where(F.col("slice").isin(slices))
        history = dedupe_latest(near.select(*load.columns).unionByName(load), S.PASSENGER_KEY, S.PASSENGER_ORDER)
        history = self._write(history, "history", "slice")

        stored = self.read("dimension").where(F.col("slice").isin(slices))
        touched = load.select("passenger_id").distinct()
        now, changes = merged_versions(
            T.stg_passengers(history), stored.drop("slice"), touched, "passenger_id", T.PASSENGER_TRACKED, "updated_at", "passenger_key", "first_seen_date",
            staged=lambda df: self._stage(df, "versions"),
        )
        changes = self._stage(changes, "changes")  # before the dimension is overwritten
        kept = stored.join(touched, "passenger_id", "left_anti")
        self._write(kept.unionByName(now.withColumn("slice", _slice()).select(*kept.columns)), "dimension", "slice")

        held = narrowed(changes, "passenger_id", ["passenger_key", "loyalty_tier"])  # what the fact and the mart hold of a version
        bookings = self.read("bookings").withColumn("is_cancelled", F.col("status") == "CANCELLED")
        moved = reresolved(bookings.select("booking_id", "passenger_id", "booking_date", "month", "fare_amount", "is_cancelled"), held, "passenger_id", "booking_date")
        moved = self._stage(moved, "moved")

        rekeyed = moved.where(~F.col("old.passenger_key").eqNullSafe(F.col("new.passenger_key")))
        months = self._parts(rekeyed, "month")
        if months:
            facts = self.read("fact").where(F.col("month").isin(months))
            keys = rekeyed.select("booking_id", F.col("new.passenger_key").alias("__new"))
            facts = facts.join(keys, "booking_id", "left").withColumn("passenger_key", F.coalesce("__new", "passenger_key")).drop("__new")
            self._write(facts.select(*self.read("fact").columns), "fact", "month")

        old_tier = F.coalesce("old.loyalty_tier", F.lit(T.UNKNOWN_PASSENGER["loyalty_tier"]))
        old_id = F.when(F.col("old").isNull(), F.lit(T.UNKNOWN_PASSENGER["passenger_id"])).otherwise(F.col("passenger_id"))
        group = lambda tier, who: [F.col("booking_date"), tier.alias("loyalty_tier"), who.alias("passenger_id")]
        delta = signed(moved, group(old_tier, old_id), group(F.col("new.loyalty_tier"), F.col("passenger_id")), _measures())
        delta = summed(None, delta, ["booking_date", "loyalty_tier", "passenger_id"]).withColumn("month", _month("booking_date"))
        delta = self._stage(delta, "delta")
        days = self._parts(delta, "month")
        if days:
            state = self.read("tier_state").where(F.col("month").isin(days))
            self._write(summed(state.select(*delta.columns), delta, ["month", "booking_date", "loyalty_tier", "passenger_id"]).select(*delta.columns), "tier_state", "month")
        self.loads += 1
        return {"history": slices, "dimension": slices, "fact": months, "tier_state": days}


def _measures() -> list[Column]:
    kept = ~F.col("is_cancelled")
    return [
        F.lit(1).cast("bigint").alias("bookings"),
        F.when(kept, 1).otherwise(0).cast("bigint").alias("kept"),
        F.when(kept, F.col("fare_amount")).otherwise(0).cast("decimal(38,2)").alias("revenue"),
    ]


def run_late_loads(spark: SparkSession, sf_dir: str) -> LateLoads:
    """All passenger extracts, the latest load date first, so that each later one is dated before what is stored; then the first again."""
    from ..session import scratch_path

    inputs = S.landing_inputs(spark, sf_dir)
    bookings, routes = T.stg_bookings(S.silver_bookings(inputs)), T.stg_routes(S.silver_routes(inputs))
    state = LateLoads(spark, scratch_path(spark, "late-loads"), bookings, T.build_dim_route(routes))
    dates = [r[0] for r in inputs.passengers.select("load_date").distinct().orderBy(F.desc("load_date")).collect()]  # one a load
    for k, date in enumerate([*dates, *dates[:1]]):
        landed = inputs.passengers.where(F.col("load_date") == date)
        if k == 0:
            state.first(S.dedupe_passengers(classify(cleanse(landed, S.PASSENGER_SPEC, keep=["load_date"]), S.PASSENGER_RULES)))
        else:
            state.merge(landed)
    return state
