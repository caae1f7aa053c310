"""Counts pinned in FIXTURES.md for the landing views at sf0.01."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MEDIUM


@pytest.fixture(scope="module")
def built(spark):
    from lakesmith.plans import silver as S
    from lakesmith.plans import star as T

    inputs = S.landing_inputs(spark, SF_MEDIUM)
    cb = S.classify_bookings(inputs).cache()
    cp = S.classify_passengers(inputs).cache()
    star = T.materialized_star(
        T.stg_bookings(S.dedupe_bookings(cb)), T.stg_passengers(S.dedupe_passengers(cp)),
        T.stg_routes(S.silver_routes(inputs)),
    )
    return inputs, cb, cp, star


def test_landing_counts(built):
    inputs, cb, cp, _ = built
    assert inputs.routes.count() == 100
    assert cb.count() == 15899
    assert cp.count() == 1892


def test_booking_reasons_and_conservation(built):
    _, cb, _, star = built
    by_reason = {r["reject_reason"]: r["count"] for r in cb.groupBy("reject_reason").count().collect()}
    assert by_reason == {
        None: 14109, "malformed_value": 977, "missing_passenger_id": 164, "negative_fare": 328,
        "invalid_status": 156, "unknown_route": 165,
    }
    silver = star.stg_bookings.count()
    assert silver == 13311
    assert 15899 == silver + 1790 + 798


def test_passenger_counts(built):
    _, _, cp, star = built
    by_reason = {r["reject_reason"]: r["count"] for r in cp.groupBy("reject_reason").count().collect()}
    assert by_reason == {None: 1868, "malformed_value": 8, "missing_passenger_id": 8, "invalid_loyalty_tier": 8}
    assert star.stg_passengers.count() == 1838
    assert star.stg_passengers.select("passenger_id").distinct().count() == 1484


def test_scd2_versions(built):
    *_, star = built
    d = star.dim_passenger.where(F.col("passenger_key") != "-1")
    assert d.count() == 1696
    dist = {r["n"]: r["count"] for r in d.groupBy("passenger_id").agg(F.count("*").alias("n")).groupBy("n").count().collect()}
    assert dist == {1: 1322, 2: 112, 3: 50}


def test_fact_attribution(built):
    *_, star = built
    f = star.fact_bookings
    assert f.count() == 13311
    assert f.where(F.col("passenger_key") == "-1").count() == 285
    p = star.dim_passenger
    non_first = f.join(p, "passenger_key").where(F.col("valid_from") > F.lit("1900-01-01").cast("date")).count()
    assert non_first == 788
    before_first = (
        star.stg_bookings.join(p.where(F.col("passenger_key") != "-1").select("passenger_id", "first_seen_date").distinct(), "passenger_id")
        .where(F.col("booking_date") < F.col("first_seen_date")).count()
    )
    assert before_first == 1827


def test_route_types(built):
    *_, star = built
    types = {r["route_type"]: r["count"] for r in star.dim_route.groupBy("route_type").count().collect()}
    assert types == {"SHORT": 18, "MEDIUM": 41, "LONG": 41, "UNKNOWN": 1}


def test_quality_suite_passes_on_good_data(built):
    from lakesmith.operators.checks import gate
    from lakesmith.plans.quality import dq_summary

    *_, star = built
    summary = dq_summary(star)
    assert summary.count() == 36
    assert gate(summary) == []
