"""The concrete data-quality suite of the booking star schema.

29 declared checks (5 unique, 11 not_null, 4 accepted_values, 4 relationships, 1 value_in_range and
4 singular checks) plus the checks of the end-to-end test suite (point-in-time containment, tier
recomputation, mart reconciliation, silver validity, contiguous versions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY
from ..operators import check_plan as P
from ..operators import checks as C
from ..operators.pit import asof_lookup
from ..operators.scd2 import OPEN_END, OPEN_START
from .silver import BOOKING_STATUSES, LOYALTY_TIERS
from .star import Star

ROUTE_TYPE_VALUES = ("SHORT", "MEDIUM", "LONG", "UNKNOWN")


def dq_unique(s: Star) -> DataFrame:
    return C.union_checks([
        C.unique(s.stg_bookings, "booking_id", "stg_bookings.booking_id"),
        C.unique(s.dim_date, "date_key", "dim_date.date_key"),
        C.unique(s.dim_route, "route_key", "dim_route.route_key"),
        C.unique(s.dim_passenger, "passenger_key", "dim_passenger.passenger_key"),
        C.unique(s.fact_bookings, "booking_id", "fact_bookings.booking_id"),
    ])


def dq_not_null(s: Star) -> DataFrame:
    return C.union_checks([
        C.not_null(s.stg_bookings, "booking_id", "stg_bookings.booking_id"),
        C.not_null(s.stg_bookings, "fare_amount", "stg_bookings.fare_amount"),
        C.not_null(s.stg_passengers, "passenger_id", "stg_passengers.passenger_id"),
        C.not_null(s.dim_date, "date_key", "dim_date.date_key"),
        C.not_null(s.dim_route, "route_key", "dim_route.route_key"),
        C.not_null(s.dim_passenger, "passenger_key", "dim_passenger.passenger_key"),
        C.not_null(s.dim_passenger, "valid_from", "dim_passenger.valid_from"),
        C.not_null(s.dim_passenger, "valid_to", "dim_passenger.valid_to"),
        C.not_null(s.fact_bookings, "booking_id", "fact_bookings.booking_id"),
        C.not_null(s.fact_bookings, "passenger_key", "fact_bookings.passenger_key"),
        C.not_null(s.fact_bookings, "route_key", "fact_bookings.route_key"),
    ])


def dq_accepted_values(s: Star) -> DataFrame:
    return C.union_checks([
        C.accepted_values(s.stg_passengers, "loyalty_tier", LOYALTY_TIERS, "stg_passengers.loyalty_tier"),
        C.accepted_values(s.dim_route, "route_type", ROUTE_TYPE_VALUES, "dim_route.route_type"),
        C.accepted_values(s.dim_passenger, "loyalty_tier", (*LOYALTY_TIERS, "UNKNOWN"), "dim_passenger.loyalty_tier"),
        C.accepted_values(s.fact_bookings, "status", BOOKING_STATUSES, "fact_bookings.status"),
    ])


def dq_relationships(s: Star) -> DataFrame:
    f = s.fact_bookings
    return C.union_checks([
        C.relationships(f, "passenger_key", s.dim_passenger, "passenger_key", "fact_bookings.passenger_key"),
        C.relationships(f, "route_key", s.dim_route, "route_key", "fact_bookings.route_key"),
        C.relationships(f, "booking_date_key", s.dim_date, "date_key", "fact_bookings.booking_date_key"),
        C.relationships(f, "travel_date_key", s.dim_date, "date_key", "fact_bookings.travel_date_key"),
    ])


def dq_value_in_range(s: Star) -> DataFrame:
    return C.value_in_range(s.mart_daily_route_revenue, "cancellation_rate", 0, 1, "mart_daily_route_revenue.cancellation_rate")


def dq_fact_reconciles(s: Star) -> DataFrame:
    """One offending row when the fact and silver differ in row count or total fare (else none).

    Both sides are reduced to one tagged row each and compared in a second tiny aggregate, so no
    cross join is needed.
    """
    tagged = s.fact_bookings.select(F.lit(1).alias("side"), "fare_amount").unionByName(
        s.stg_bookings.select(F.lit(2).alias("side"), "fare_amount")
    )
    t = tagged.agg(
        F.count_if(F.col("side") == 1).alias("fact_rows"),
        F.count_if(F.col("side") == 2).alias("silver_rows"),
        F.sum(F.when(F.col("side") == 1, F.col("fare_amount"))).alias("fact_fare"),
        F.sum(F.when(F.col("side") == 2, F.col("fare_amount"))).alias("silver_fare"),
    )
    offending = t.where((F.col("fact_rows") != F.col("silver_rows")) | ~F.col("fact_fare").eqNullSafe(F.col("silver_fare")))
    return C.failing_rows("fact_reconciles_to_silver", "fact_bookings", offending)


def dq_known_keys_resolve(s: Star) -> DataFrame:
    """Bookings on the unknown member although their passenger exists in the staging history."""
    on_unknown = s.fact_bookings.where(F.col("passenger_key") == UNKNOWN_KEY).select("booking_id")
    known = s.stg_passengers.select("passenger_id")
    offending = (
        s.stg_bookings.select("booking_id", "passenger_id")
        .join(on_unknown, "booking_id")
        .join(known, "passenger_id", "left_semi")
    )
    return C.failing_rows("known_passengers_resolve_to_a_version", "fact_bookings", offending)


def dq_one_current_version(s: Star) -> DataFrame:
    offending = (
        s.dim_passenger.where("is_current").groupBy("passenger_id").agg(F.count(F.lit(1)).alias("n")).where("n <> 1")
    )
    return C.failing_rows("one_current_version_per_passenger", "dim_passenger", offending)


def dq_scd2_overlap(s: Star) -> DataFrame:
    return C.union_checks([
        C.overlapping_windows(s.dim_passenger, ["passenger_id"], "valid_from", "valid_to", "passenger_key", "dim_passenger"),
        C.empty_windows(s.dim_passenger, "valid_from", "valid_to", "dim_passenger"),
    ])


def dq_pit_containment(s: Star) -> DataFrame:
    """Attributed bookings whose booking date falls outside their version's window."""
    v = s.dim_passenger.select("passenger_key", "valid_from", "valid_to")
    j = (
        s.fact_bookings.where(F.col("passenger_key") != UNKNOWN_KEY)
        .select("booking_id", "passenger_key")
        .join(s.stg_bookings.select("booking_id", "booking_date"), "booking_id")
        .join(v, "passenger_key")
    )
    offending = j.where(~((F.col("booking_date") >= F.col("valid_from")) & (F.col("booking_date") < F.col("valid_to"))))
    return C.failing_rows("point_in_time_containment", "fact_bookings", offending)


def tier_recompute(s: Star) -> DataFrame:
    """Per booking: tier in force on the booking date recomputed from the staging history (as-of
    lookup) next to the tier of the version the fact points at."""
    expected = asof_lookup(
        s.stg_bookings.select("booking_id", "passenger_id", "booking_date"),
        s.stg_passengers, ["passenger_id"], "booking_date", "updated_at", ["loyalty_tier"], prefix="expected_",
    )
    resolved = s.fact_bookings.select("booking_id", "passenger_key").join(
        s.dim_passenger.select("passenger_key", F.col("loyalty_tier").alias("resolved_tier")), "passenger_key"
    )
    return expected.join(resolved, "booking_id").select(
        "booking_id", "passenger_key", F.col("expected_loyalty_tier").alias("expected_tier"), "resolved_tier"
    )


def dq_tier_recompute(s: Star) -> DataFrame:
    t = tier_recompute(s)
    offending = t.where(F.col("resolved_tier") != F.col("expected_tier"))
    return C.failing_rows("tier_equals_recomputation", "fact_bookings", offending)


def dq_marts_reconcile(s: Star) -> DataFrame:
    """Number of failed equalities between the marts' totals and the fact (0..4)."""
    f = s.fact_bookings.select(
        F.lit("fact").alias("src"), F.lit(1).cast("bigint").alias("bookings"),
        F.when(~F.col("is_cancelled"), F.col("fare_amount")).cast("decimal(38,2)").alias("gross_revenue"),
    )
    r = s.mart_daily_route_revenue.select(F.lit("route").alias("src"), "bookings", "gross_revenue")
    t = s.mart_revenue_by_loyalty_tier.select(F.lit("tier").alias("src"), "bookings", "gross_revenue")
    tot = f.unionByName(r).unionByName(t).groupBy().agg(
        *[F.sum(F.when(F.col("src") == src, F.col(m))).alias(f"{src}_{m}")
          for src in ("fact", "route", "tier") for m in ("bookings", "gross_revenue")]
    )
    failed = sum(
        (~F.col(f"{m}_{x}").eqNullSafe(F.col(f"fact_{x}"))).cast("int")
        for m in ("route", "tier")
        for x in ("bookings", "gross_revenue")
    )
    return tot.select(
        F.lit("marts_reconcile_to_fact").alias("check_name"), F.lit("marts").alias("target"),
        failed.cast("bigint").alias("violations"),
    )


def _invalid_booking() -> Column:
    """A NULL fare or status is as invalid as a wrong one."""
    valid = (F.col("fare_amount") >= 0) & F.col("passenger_id").isNotNull() & F.col("status").isin(*BOOKING_STATUSES)
    return ~F.coalesce(valid, F.lit(False))


def _unclean_passenger() -> Column:
    return (F.col("email") != F.lower(F.trim("email"))) | (F.col("full_name") != F.trim("full_name"))


def dq_silver_valid(s: Star) -> DataFrame:
    b = s.stg_bookings.where(_invalid_booking())
    p = s.stg_passengers.where(_unclean_passenger())
    return C.union_checks([
        C.failing_rows("silver_rows_valid", "stg_bookings", b),
        C.failing_rows("silver_text_clean", "stg_passengers", p),
    ])


def dq_contiguous_versions(s: Star) -> DataFrame:
    """Passengers whose versions do not start at the open start, end at the open end, chain
    without gaps and have exactly one current version."""
    v = s.dim_passenger.where(F.col("passenger_key") != UNKNOWN_KEY)
    w = Window.partitionBy("passenger_id").orderBy("valid_from")
    v = v.withColumn("__next", F.lead("valid_from").over(w))
    per = v.groupBy("passenger_id").agg(
        F.min("valid_from").alias("first_from"),
        F.max("valid_to").alias("last_to"),
        F.count_if("is_current").alias("current"),
        F.bool_and(F.col("__next").isNull() | (F.col("__next") == F.col("valid_to"))).alias("chained"),
    )
    offending = per.where(
        (F.col("first_from") != F.lit(OPEN_START)) | (F.col("last_to") != F.lit(OPEN_END))
        | (F.col("current") != 1) | ~F.col("chained")
    )
    return C.failing_rows("contiguous_versions", "dim_passenger", offending)


DECLARED = (dq_unique, dq_not_null, dq_accepted_values, dq_relationships, dq_value_in_range,
            dq_fact_reconciles, dq_known_keys_resolve, dq_one_current_version, dq_scd2_overlap)
EXTENDED = (dq_pit_containment, dq_tier_recompute, dq_marts_reconcile, dq_silver_valid, dq_contiguous_versions)


def dq_each(s: Star, extended: bool = True) -> DataFrame:
    """The checks one by one: a scan or more for each."""
    suite = DECLARED + (EXTENDED if extended else ())
    return C.union_checks([check(s) for check in suite])


def _declared() -> list[P.Check]:
    """The declared checks of single tables and keys, as data."""
    fact, silver = F.count(F.lit(1)), F.sum("fare_amount")
    reconciles = ("fact_reconciles_to_silver", "fact_bookings")
    return [
        P.Unique("stg_bookings", "booking_id"),
        P.Unique("dim_date", "date_key"),
        P.Unique("dim_route", "route_key"),
        P.Unique("dim_passenger", "passenger_key"),
        P.Unique("fact_bookings", "booking_id"),
        *[P.not_null(table, column) for table, columns in (
            ("stg_bookings", ("booking_id", "fare_amount")),
            ("stg_passengers", ("passenger_id",)),
            ("dim_date", ("date_key",)),
            ("dim_route", ("route_key",)),
            ("dim_passenger", ("passenger_key", "valid_from", "valid_to")),
            ("fact_bookings", ("booking_id", "passenger_key", "route_key")),
        ) for column in columns],
        P.Values("stg_passengers", "loyalty_tier", LOYALTY_TIERS),
        P.Values("dim_route", "route_type", ROUTE_TYPE_VALUES),
        P.Values("dim_passenger", "loyalty_tier", (*LOYALTY_TIERS, "UNKNOWN")),
        P.Values("fact_bookings", "status", BOOKING_STATUSES),
        P.Refers("fact_bookings", "passenger_key", "dim_passenger", "passenger_key"),
        P.Refers("fact_bookings", "route_key", "dim_route", "route_key"),
        P.Refers("fact_bookings", "booking_date_key", "dim_date", "date_key"),
        P.Refers("fact_bookings", "travel_date_key", "dim_date", "date_key"),
        P.in_range("mart_daily_route_revenue", "cancellation_rate", 0, 1),
        *[P.Total(*reconciles, item, side, table, value, once=True)
          for side, table in enumerate(("fact_bookings", "stg_bookings")) for item, value in (("rows", fact), ("fare", silver))],
        P.RowRule("proper_windows", "dim_passenger", "dim_passenger", ~(F.col("valid_from") < F.col("valid_to"))),
    ]


def _extended() -> list[P.Check]:
    gross = F.sum(F.when(~F.col("is_cancelled"), F.col("fare_amount")))
    checks: list[P.Check] = [
        P.RowRule("silver_rows_valid", "stg_bookings", "stg_bookings", _invalid_booking()),
        P.RowRule("silver_text_clean", "stg_passengers", "stg_passengers", _unclean_passenger()),
    ]
    for mart in ("mart_daily_route_revenue", "mart_revenue_by_loyalty_tier"):
        for item, own, fact in (("bookings", F.sum("bookings"), F.count(F.lit(1))), ("gross_revenue", F.sum("gross_revenue"), gross)):
            item = f"{mart}.{item}"
            checks.append(P.Total("marts_reconcile_to_fact", "marts", item, 0, mart, own))
            checks.append(P.Total("marts_reconcile_to_fact", "marts", item, 1, "fact_bookings", fact))
    return checks


def version_pass(s: Star, extended: bool) -> DataFrame:
    """Overlaps, current versions and contiguity of each passenger, from one scan, shuffle and sort of the versions.

    Every version gives its start, with what is known of it, and its end; a sweep over both counts the open windows."""
    by_key = Window.partitionBy("passenger_id")
    v = s.dim_passenger.select("passenger_key", "passenger_id", "valid_from", "valid_to", "is_current")
    v = v.withColumn("next_from", F.lead("valid_from").over(by_key.orderBy("valid_from")))
    proper = F.col("valid_from") < F.col("valid_to")
    start = F.struct(F.col("valid_from").alias("t"), F.when(proper, 1).otherwise(0).alias("step"))
    end = F.struct(F.col("valid_to").alias("t"), F.lit(-1).alias("step"))
    v = v.withColumn("event", F.explode(F.when(proper, F.array(start, end)).otherwise(F.array(start)))).select("*", "event.*")
    sweep = by_key.orderBy("t", "step", "passenger_key").rowsBetween(Window.unboundedPreceding, -1)
    v = v.withColumn("open", F.coalesce(F.sum("step").over(sweep), F.lit(0)))
    version = F.col("step") >= 0  # not an end
    per = v.groupBy("passenger_id").agg(
        F.sum(F.when(F.col("step") == 1, F.col("open"))).alias("overlaps"),
        F.count_if(version & F.col("is_current")).alias("current"),
        F.min(F.when(version, F.col("valid_from"))).alias("first_from"),
        F.max(F.when(version, F.col("valid_to"))).alias("last_to"),
        F.bool_and(F.when(version, F.col("next_from").isNull() | (F.col("next_from") == F.col("valid_to")))).alias("chained"),
        F.bool_and(F.col("passenger_key") == UNKNOWN_KEY).alias("unknown"),
    )
    broken = (F.col("first_from") != F.lit(OPEN_START)) | (F.col("last_to") != F.lit(OPEN_END)) | (F.col("current") != 1) | ~F.col("chained")
    one = per.agg(
        F.sum("overlaps").alias("overlaps"),
        F.count_if(F.col("current") > 1).alias("several"),
        F.count_if(~F.col("unknown") & broken).alias("broken"),
    )
    entries = [
        P.found("no_overlapping_windows", "dim_passenger", F.col("overlaps")),
        P.found("one_current_version_per_passenger", "dim_passenger", F.col("several")),
    ]
    if extended:
        entries.append(P.found("contiguous_versions", "dim_passenger", F.col("broken")))
    return P.results(one, entries)


def resolution_pass(s: Star, extended: bool) -> DataFrame:
    """How the fact's bookings were resolved, from one join of the fact with silver and the versions."""
    known = s.stg_passengers.select(F.col("passenger_id").alias("known_id")).distinct()
    bookings = s.stg_bookings.select("booking_id", "passenger_id", "booking_date")
    if extended:
        bookings = asof_lookup(bookings, s.stg_passengers, ["passenger_id"], "booking_date", "updated_at", ["loyalty_tier"], prefix="expected_")
    fact = s.fact_bookings.select("booking_id", "passenger_key")
    j = fact.join(bookings, "booking_id").join(known, F.col("passenger_id") == F.col("known_id"), "left")
    unknown = F.col("passenger_key") == UNKNOWN_KEY
    counts = [F.count_if(unknown & F.col("known_id").isNotNull()).alias("lost")]
    entries = [P.found("known_passengers_resolve_to_a_version", "fact_bookings", F.col("lost"))]
    if extended:
        # a key has one version; where a damaged dimension has several, each counts, and no booking is counted anew
        v = s.dim_passenger.groupBy(F.col("passenger_key").alias("version_key")).agg(F.collect_list(F.struct("valid_from", "valid_to", "loyalty_tier")).alias("versions"))
        j = j.join(v, F.col("passenger_key") == F.col("version_key"), "left")
        n = lambda wrong: F.sum(F.greatest(F.size(F.filter("versions", wrong)), F.lit(0)))
        outside = lambda x: ~unknown & ~((F.col("booking_date") >= x["valid_from"]) & (F.col("booking_date") < x["valid_to"]))
        counts += [n(outside).alias("outside"), n(lambda x: x["loyalty_tier"] != F.col("expected_loyalty_tier")).alias("wrong")]
        entries += [P.found("point_in_time_containment", "fact_bookings", F.col("outside")), P.found("tier_equals_recomputation", "fact_bookings", F.col("wrong"))]
    return P.results(j.agg(*counts), entries)


def dq_summary(s: Star, extended: bool = True) -> DataFrame:
    """All checks, planned together: an aggregate a table, one key count, one pass of the versions and one of the resolution."""
    names = ("stg_bookings", "stg_passengers", "dim_date", "dim_route", "dim_passenger", "fact_bookings",
             "mart_daily_route_revenue", *(("mart_revenue_by_loyalty_tier",) if extended else ()))
    checks = _declared() + (_extended() if extended else [])
    return P.compile_checks({n: getattr(s, n) for n in names}, checks, [version_pass(s, extended), resolution_pass(s, extended)])
