"""Incremental silver: a replayed epoch (as after a lost executor) changes nothing, and the
merged table equals the full rebuild."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from lakesmith.operators.parity import symmetric_difference
from lakesmith.plans import silver as S
from lakesmith.session import scratch_path
from lakesmith.sources.files import write_parquet
from lakesmith.streaming.incremental import merge_bookings_batch
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.select(*S.SILVER_BOOKING_COLUMNS).collect())


def test_replayed_epoch_is_idempotent_and_equals_full_rebuild(spark):
    inputs = S.landing_inputs(spark, SF_SMALL)
    root = scratch_path(spark, "stream-test")
    routes = os.path.join(root, "routes")
    write_parquet(S.silver_routes(inputs), routes)
    silver = os.path.join(root, "silver")
    quarantine = os.path.join(root, "quarantine")
    work = os.path.join(root, "work")
    day1 = inputs.bookings.where(F.col("load_date") == "2001-09-01")
    day2 = inputs.bookings.where(F.col("load_date") == "2001-09-02")

    merge_bookings_batch(day1, 0, routes, silver, quarantine, work)
    merge_bookings_batch(day2, 1, routes, silver, quarantine, work)
    once = _rows(spark.read.parquet(silver))
    merge_bookings_batch(day2, 1, routes, silver, quarantine, work)  # replay
    twice = _rows(spark.read.parquet(silver))
    assert once == twice

    merged = spark.read.parquet(silver).withColumn("booking_date", F.col("booking_date").cast("date"))
    diff = symmetric_difference(merged.select(*S.SILVER_BOOKING_COLUMNS), S.silver_bookings(inputs), "silver").first()
    assert (diff["only_left"], diff["only_right"]) == (0, 0)
    assert diff["left_rows"] > 0
    q = spark.read.parquet(quarantine)
    assert q.count() == S.quarantine_bookings(inputs).count()


def _paths(spark, inputs):
    root = scratch_path(spark, "stream-crash")
    routes, silver, quarantine, work = (os.path.join(root, x) for x in ("routes", "silver", "quarantine", "work"))
    write_parquet(S.silver_routes(inputs), routes)
    return routes, silver, quarantine, work


def test_crash_between_delete_and_write_replays_to_the_full_rebuild(spark):
    inputs = S.landing_inputs(spark, SF_SMALL)
    paths = _paths(spark, inputs)
    silver = paths[1]
    days = [inputs.bookings.where(F.col("load_date") == d) for d in ("2001-09-01", "2001-09-02")]
    for epoch, day in enumerate(days):
        merge_bookings_batch(day, epoch, *paths)
    once = _rows(spark.read.parquet(silver))
    touched = [r[0] for r in spark.read.parquet(os.path.join(paths[3], "rebuilt/epoch=1")).select("booking_date").distinct().collect()]
    for d in touched:  # the overwrite removes old files before the new ones stand
        shutil.rmtree(os.path.join(silver, f"booking_date={d}").removeprefix("file:"))
    assert len(spark.read.parquet(silver).take(len(once))) < len(once)
    merge_bookings_batch(days[1], 1, *paths)
    assert _rows(spark.read.parquet(silver)) == once


def test_date_left_by_its_only_booking_goes_alone(spark):
    inputs = S.landing_inputs(spark, SF_SMALL)
    paths = _paths(spark, inputs)
    good = S.silver_bookings(inputs).select("booking_id").orderBy("booking_id").limit(2)
    two = inputs.bookings.join(good, "booking_id", "left_semi").select(inputs.bookings.columns).dropDuplicates(["booking_id"])
    rows = [r.asDict() | {"status": "CONFIRMED", "fare_amount": "10.00", "travel_date": "2001-03-01", "updated_ts": "2001-01-01 00:00:00"} for r in two.collect()]
    schema = inputs.bookings.schema
    rows = [r | {"booking_ts": f"2001-01-0{i + 1} 08:00:00"} for i, r in enumerate(rows)]
    moved = rows[0] | {"booking_ts": "2001-01-07 08:00:00", "updated_ts": "2001-01-02 00:00:00"}

    def frame(some):
        return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in some], schema)

    merge_bookings_batch(frame(rows), 0, *paths)
    assert sorted(str(r[0]) for r in spark.read.parquet(paths[1]).select("booking_date").collect()) == ["2001-01-01", "2001-01-02"]
    kept = os.path.join(paths[1], "booking_date=2001-01-02").removeprefix("file:")
    before = sorted(os.listdir(kept))
    for _ in range(2):  # the second is a replay
        merge_bookings_batch(frame([moved]), 1, *paths)
        assert sorted(str(r[0]) for r in spark.read.parquet(paths[1]).select("booking_date").collect()) == ["2001-01-02", "2001-01-07"]
    assert sorted(os.listdir(kept)) == before


def test_unreadable_silver_raises(spark):
    inputs = S.landing_inputs(spark, SF_SMALL)
    paths = _paths(spark, inputs)
    merge_bookings_batch(inputs.bookings.where(F.col("load_date") == "2001-09-01"), 0, *paths)
    path = paths[1].removeprefix("file:")
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(folder, n), "wb") as f:
                    f.write(b"PAR1 broken")
                if os.path.exists(crc := os.path.join(folder, f".{n}.crc")):
                    os.remove(crc)
    with pytest.raises(Exception, match="(?i)parquet|corrupt|read"):
        merge_bookings_batch(inputs.bookings.where(F.col("load_date") == "2001-09-02"), 1, *paths)


def test_steps_of_a_batch_that_are_read_again_are_staged(spark):
    """The batch's latest versions, the silver rows that they replace and the dates of both."""
    inputs = S.landing_inputs(spark, SF_SMALL)
    paths = _paths(spark, inputs)
    days = [inputs.bookings.where(F.col("load_date") == d) for d in ("2001-09-01", "2001-09-02")]
    merge_bookings_batch(days[0], 0, *paths)
    before = spark.createDataFrame(spark.read.parquet(paths[1]).select("booking_id", "booking_date").collect(), "booking_id string, booking_date date")
    merge_bookings_batch(days[1], 1, *paths)
    latest, affected, dates = (spark.read.parquet(os.path.join(paths[3], f"{x}/epoch=1")) for x in ("latest", "affected", "dates"))
    ids = {r[0] for r in latest.select("booking_id").collect()}
    assert len(ids) == latest.count() > 0
    old = {r.booking_id: r.booking_date for r in before.collect() if r.booking_id in ids}
    assert old and {r.booking_id: r.booking_date for r in affected.collect()} == old
    assert {r[0] for r in dates.collect()} == set(old.values()) | {r[0] for r in latest.select("booking_date").collect()}
