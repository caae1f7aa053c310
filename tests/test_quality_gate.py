"""The quality suite reports violations on corrupted copies and the gate refuses to publish."""

import pytest
from pyspark.sql import functions as F

from lakesmith.functions.keys import UNKNOWN_KEY
from lakesmith.operators.checks import QualityGateError, gate
from lakesmith.plans import quality as Q
from lakesmith.plans import silver as S
from lakesmith.plans import star as T
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def star(spark):
    inputs = S.landing_inputs(spark, SF_SMALL)
    return T.materialized_star(
        T.stg_bookings(S.silver_bookings(inputs)), T.stg_passengers(S.silver_passengers(inputs)),
        T.stg_routes(S.silver_routes(inputs)),
    )


def _violations(df):
    return {(r["check_name"], r["target"]): r["violations"] for r in df.collect()}


def test_good_data_passes(star):
    assert all(v == 0 for v in _violations(Q.dq_summary(star)).values())


def test_duplicate_route_breaks_unique(star):
    bad = T.Star(**{**star.__dict__, "dim_route": star.dim_route.unionByName(star.dim_route.limit(1))})
    v = _violations(Q.dq_unique(bad))
    assert v[("unique", "dim_route.route_key")] == 1


def test_nulls_and_bad_values_are_counted(star):
    fact = star.fact_bookings.withColumn(
        "status", F.when(F.col("booking_id") == F.lit(star.fact_bookings.first()["booking_id"]), "LOST").otherwise(F.col("status"))
    ).withColumn("route_key", F.when(F.col("status") == "LOST", F.lit(None)).otherwise(F.col("route_key")))
    bad = T.Star(**{**star.__dict__, "fact_bookings": fact})
    assert _violations(Q.dq_accepted_values(bad))[("accepted_values", "fact_bookings.status")] == 1
    assert _violations(Q.dq_not_null(bad))[("not_null", "fact_bookings.route_key")] == 1


def test_overlapping_version_is_detected(star):
    p = star.dim_passenger
    first = p.where(~F.col("is_current")).first()
    shifted = p.where(F.col("passenger_key") == first["passenger_key"]).select(
        F.md5(F.lit("extra")).alias("passenger_key"), *[c for c in p.columns if c != "passenger_key"]
    ).withColumn("is_current", F.lit(True))
    bad = T.Star(**{**star.__dict__, "dim_passenger": p.unionByName(shifted)})
    v = _violations(Q.dq_scd2_overlap(bad))
    assert v[("no_overlapping_windows", "dim_passenger")] >= 1
    assert _violations(Q.dq_one_current_version(bad))[("one_current_version_per_passenger", "dim_passenger")] == 1


def test_orphan_fact_key_and_reconciliation(star):
    fact = star.fact_bookings.unionByName(
        star.fact_bookings.limit(1).withColumn("passenger_key", F.lit("nope")).withColumn("booking_id", F.lit("Bxx"))
    )
    bad = T.Star(**{**star.__dict__, "fact_bookings": fact})
    assert _violations(Q.dq_relationships(bad))[("relationships", "fact_bookings.passenger_key")] == 1
    assert _violations(Q.dq_fact_reconciles(bad))[("fact_reconciles_to_silver", "fact_bookings")] == 1
    with pytest.raises(QualityGateError):
        gate(Q.dq_summary(bad, extended=False))


def _with(star, **tables):
    return T.Star(**{**star.__dict__, **tables})


def _only(df):
    return sum(r["violations"] for r in df.collect())


def test_rate_out_of_range(star):
    mart = star.mart_daily_route_revenue
    assert _only(Q.dq_value_in_range(_with(star, mart_daily_route_revenue=mart.withColumn("cancellation_rate", F.lit(1.5))))) == mart.count()


def test_known_passenger_on_unknown_member(star):
    known = star.fact_bookings.where(F.col("passenger_key") != UNKNOWN_KEY)
    one = known.orderBy("booking_id").first()["booking_id"]
    fact = star.fact_bookings.withColumn(
        "passenger_key", F.when(F.col("booking_id") == one, F.lit(UNKNOWN_KEY)).otherwise(F.col("passenger_key"))
    )
    assert _only(Q.dq_known_keys_resolve(_with(star, fact_bookings=fact))) == 1


def test_booking_outside_its_versions_window(star):
    p = star.dim_passenger.withColumn("valid_from", F.col("valid_to"))
    bad = _with(star, dim_passenger=p)
    attributed = star.fact_bookings.where(F.col("passenger_key") != UNKNOWN_KEY).count()
    assert _only(Q.dq_pit_containment(bad)) == attributed
    assert _violations(Q.dq_scd2_overlap(bad))[("proper_windows", "dim_passenger")] == p.count()


def test_wrong_tier_of_a_version(star):
    used = star.fact_bookings.where(F.col("passenger_key") != UNKNOWN_KEY).orderBy("booking_id").first()["passenger_key"]
    hit = F.col("passenger_key") == used
    p = star.dim_passenger.withColumn("loyalty_tier", F.when(hit, F.lit("OTHER")).otherwise(F.col("loyalty_tier")))
    assert _only(Q.dq_tier_recompute(_with(star, dim_passenger=p))) == star.fact_bookings.where(hit).count()


def test_mart_that_lost_a_row(star):
    mart = star.mart_revenue_by_loyalty_tier
    least = mart.orderBy("bookings").first()
    short = mart.where(F.col("loyalty_tier") != least["loyalty_tier"])
    assert _only(Q.dq_marts_reconcile(_with(star, mart_revenue_by_loyalty_tier=short))) >= 1


def test_invalid_silver(star):
    n = star.stg_bookings.count()
    assert _only(Q.dq_silver_valid(_with(star, stg_bookings=star.stg_bookings.withColumn("fare_amount", F.lit(-1))))) == n
    dirty = star.stg_passengers.withColumn("full_name", F.concat(F.lit(" "), F.coalesce("full_name", F.lit("x"))))
    assert _only(Q.dq_silver_valid(_with(star, stg_passengers=dirty))) == dirty.count()


def test_gap_between_versions(star):
    first = star.dim_passenger.where(~F.col("is_current")).orderBy("passenger_key").first()
    hit = F.col("passenger_key") == first["passenger_key"]
    p = star.dim_passenger.withColumn("valid_to", F.when(hit, F.date_sub("valid_to", 1)).otherwise(F.col("valid_to")))
    assert _only(Q.dq_contiguous_versions(_with(star, dim_passenger=p))) == 1


def test_checks_planned_together_equal_the_checks_one_by_one(star):
    """On good data, and on a copy in which every table is damaged in several ways, NULLs among them."""
    fact, p, b = star.fact_bookings, star.dim_passenger, star.stg_bookings
    nth = lambda df, key, k: df.orderBy(key).limit(k)
    damaged = _with(
        star,
        stg_bookings=b.withColumn("fare_amount", F.when(F.pmod(F.crc32("booking_id"), F.lit(50)) == 0, F.lit(None)).otherwise(F.col("fare_amount")))
        .withColumn("status", F.when(F.pmod(F.crc32("booking_id"), F.lit(41)) == 0, F.lit(None)).otherwise(F.col("status"))).unionByName(nth(b, "booking_id", 3)),
        stg_passengers=star.stg_passengers.withColumn("loyalty_tier", F.when(F.pmod(F.crc32("passenger_id"), F.lit(9)) == 0, F.col("passenger_id")).otherwise(F.col("loyalty_tier"))),
        dim_date=star.dim_date.where("month(date_day) != 3").unionByName(star.dim_date.limit(2)),
        dim_route=star.dim_route.withColumn("route_type", F.lit("ODD")).where("origin != 'N1'"),
        dim_passenger=p.withColumn("valid_to", F.when(F.pmod(F.crc32("passenger_key"), F.lit(7)) == 0, F.col("valid_from")).otherwise(F.col("valid_to")))
        .withColumn("is_current", F.col("is_current") | (F.pmod(F.crc32("passenger_key"), F.lit(5)) == 0)).unionByName(nth(p, "passenger_key", 4).withColumn("valid_from", F.lit(None).cast("date"))),
        fact_bookings=fact.withColumn("passenger_key", F.when(F.pmod(F.crc32("booking_id"), F.lit(11)) == 0, F.lit(UNKNOWN_KEY)).when(F.pmod(F.crc32("booking_id"), F.lit(13)) == 0, F.lit("gone")).otherwise(F.col("passenger_key")))
        .withColumn("status", F.when(F.pmod(F.crc32("booking_id"), F.lit(17)) == 0, F.col("booking_id")).otherwise(F.col("status"))).unionByName(nth(fact, "booking_id", 5)),
        mart_daily_route_revenue=star.mart_daily_route_revenue.withColumn("cancellation_rate", F.lit(-1.0)).where("origin != 'N2'"),
    )
    for copy in (star, damaged):
        for extended in (True, False):
            together, each = Q.dq_summary(copy, extended), Q.dq_each(copy, extended)
            assert _violations(together) == _violations(each) and together.count() == each.count()
    found = _violations(Q.dq_summary(damaged))
    assert sum(v > 0 for v in found.values()) >= 20, found


def test_fares_that_are_all_null_do_not_reconcile(star):
    fact = star.fact_bookings.withColumn("fare_amount", F.lit(None).cast("decimal(10,2)"))
    assert _only(Q.dq_fact_reconciles(_with(star, fact_bookings=fact))) == 1
    assert _violations(Q.dq_summary(_with(star, fact_bookings=fact)))[("fact_reconciles_to_silver", "fact_bookings")] == 1


def test_null_status_is_invalid(star):
    b = star.stg_bookings.withColumn("status", F.lit(None).cast("string"))
    assert _violations(Q.dq_silver_valid(_with(star, stg_bookings=b)))[("silver_rows_valid", "stg_bookings")] == b.count()


def test_summary_scans_each_table_few_times(star):
    plan = Q.dq_summary(star)._jdf.queryExecution().sparkPlan().toString()
    scans = {name: plan.count(f"/{name}-") for name in ("stg-bookings", "stg-passengers", "dim-date", "dim-route", "dim-passenger", "fact-bookings", "mart-route", "mart-tier")}
    assert scans["fact-bookings"] <= 3 and scans["dim-passenger"] <= 4 and scans["dim-route"] <= 2 and scans["dim-date"] <= 2 and scans["mart-route"] == scans["mart-tier"] == 1, scans
