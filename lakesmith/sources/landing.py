"""Landing extracts derived from the driver tables.

The driver data holds no airline extracts, so the landing files of the ingest (routes, bookings,
passengers) are derived from ``nation``, ``orders`` and ``customer`` by fixed arithmetic on the key.
Every output column is text, exactly as a CSV extract would deliver it, including injected
defects (blank ids, bad casts, unknown codes, messy case and blanks) and re-sent versions.

Each view scans its source table once: the extra "arms" of an extract (re-sent rows, updates,
exact copies) are produced by exploding a small per-row array of arm ids, not by a UNION over
several scans of the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# The columns of the landing extracts, and the values that they are derived with.
ROUTE_COLUMNS = ["route_code", "origin", "destination", "distance_miles"]
BOOKING_COLUMNS = [
    "booking_id", "passenger_id", "route_code", "booking_ts", "travel_date",
    "fare_amount", "currency", "status", "channel", "updated_ts",
]
PASSENGER_COLUMNS = ["passenger_id", "full_name", "email", "loyalty_tier", "home_airport", "updated_at"]
TIERS_BY_RESIDUE = ["NONE", "BLUE", "SILVER", "GOLD"]  # loyalty tier for key % 4 = 0, 1, 2, 3
FIRST_LOAD = "2001-09-01"
SECOND_LOAD = "2001-09-02"
PASSENGER_BASE_DATE = "1995-06-01"


# Bookings whose number leaves one of these remainders get a field too many, or only their first four.
LINE_CLASSES, SURPLUS_CLASS, SHORT_CLASS, SHORT_FIELDS = 89, 13, 14, 4


def booking_lines(bookings: DataFrame) -> DataFrame:
    """``value`` and ``load_date``: landing bookings as CSV lines without a header, some of them of the wrong width."""
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
    line = F.to_csv(F.struct(*BOOKING_COLUMNS), options)
    residue = F.expr("try_cast(substring(booking_id, 2) AS bigint)") % LINE_CLASSES
    short = F.substring_index(line, ",", SHORT_FIELDS)
    value = F.when(residue == SURPLUS_CLASS, F.concat(line, F.lit(",surplus"))).when(residue == SHORT_CLASS, short)
    return bookings.select(value.otherwise(line).alias("value"), "load_date")


def _s(c: Column) -> Column:
    return c.cast("string")


def _lpad_key(c: Column, width: int) -> Column:
    """The key as text, padded with zeros to ``width``; longer keys stay whole."""
    return F.lpad(_s(c), F.greatest(F.lit(width), F.length(_s(c))), F.lit("0"))


def landing_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes between different nations of one region; every fifth origin has messy case/blanks."""
    a = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("a_key"), F.col("n_regionkey").alias("a_region")
    )
    b = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("b_key"), F.col("n_regionkey").alias("b_region")
    )
    pairs = a.join(b, (F.col("a_region") == F.col("b_region")) & (F.col("a_key") != F.col("b_key")))
    code = F.concat(F.lit("N"), _s(F.col("a_key")), F.lit("-N"), _s(F.col("b_key")))
    return pairs.select(
        F.when(F.col("a_key") % 5 == 0, F.concat(F.lit(" "), F.lower(code), F.lit(" ")))
        .otherwise(code)
        .alias("route_code"),
        F.concat(F.lit("N"), _s(F.col("a_key"))).alias("origin"),
        F.concat(F.lit("N"), _s(F.col("b_key"))).alias("destination"),
        _s(F.lit(150) + (F.col("a_key") * 137 + F.col("b_key") * 71) % 1751).alias("distance_miles"),
    )


def landing_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One booking per order plus cancelling re-sends (key % 20 = 0) and exact copies (key % 101 = 50).

    Defects are chosen by ``key % 97``; see FIXTURES.md for the table of classes.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    cls = k % 97
    order_day = F.to_date("o_orderdate")

    route_from = k % 25
    route_to = (k % 25 + 5 * (1 + F.floor(k / 25) % 4)) % 25
    route = F.concat(F.lit("N"), _s(route_from), F.lit("-N"), _s(route_to))
    clean_ts = F.concat(_s(order_day), F.lit(" 0"), _s(k % 10), F.lit(":15:00"))
    status = (
        F.when(F.col("o_orderstatus") == "F", "FLOWN")
        .when(F.col("o_orderstatus") == "O", "CONFIRMED")
        .when(k % 2 == 0, "CANCELLED")
        .otherwise("CHECKED_IN")
    )

    finished = o.select(
        k.alias("k"),
        F.when(cls == 10, " ").otherwise(F.concat(F.lit("B"), _lpad_key(k, 9))).alias("booking_id"),
        F.when(cls == 2, "   ")
        .when(cls == 12, F.concat(F.lit("U"), _lpad_key(k, 7)))
        .otherwise(F.concat(F.lit("P"), _lpad_key(F.col("o_custkey"), 7)))
        .alias("passenger_id"),
        F.when(cls == 4, "XXX-YYY")
        .when(cls == 21, F.concat(F.lit(" "), F.lower(route)))
        .otherwise(route)
        .alias("route_code"),
        F.when(cls == 8, "garbage-ts").otherwise(clean_ts).alias("booking_ts"),
        F.when(cls == 7, "2024-02-31")
        .otherwise(_s(F.date_add(order_day, (1 + k % 60).cast("int"))))
        .alias("travel_date"),
        F.when(cls.isin(1, 11), "-25.00")
        .when(cls == 5, "abc")
        .when(cls == 6, "12,50")
        .otherwise(_s(F.col("o_totalprice").cast("decimal(10,2)")))
        .alias("fare_amount"),
        F.lit("USD").alias("currency"),
        F.when(cls.isin(3, 11), "BOGUS")
        .when(cls == 20, F.concat(F.lit(" "), F.lower(status), F.lit(" ")))
        .otherwise(status)
        .alias("status"),
        F.when(k % 3 == 0, "WEB").when(k % 3 == 1, "MOBILE").otherwise("AGENT").alias("channel"),
        F.when(cls == 9, "??").otherwise(clean_ts).alias("updated_ts"),
        F.when(k % 2 == 0, FIRST_LOAD).otherwise(SECOND_LOAD).alias("load_date"),
    )
    # arm 0: the booking itself, 1: cancelling update, 2: exact re-sent copy
    kk = F.col("k")
    arms = F.array_compact(F.array(F.lit(0), F.when(kk % 20 == 0, F.lit(1)), F.when(kk % 101 == 50, F.lit(2))))
    exploded = finished.withColumn("arm", F.explode(arms))
    is_update = F.col("arm") == 1
    return exploded.select(
        "booking_id", "passenger_id", "route_code", "booking_ts", "travel_date", "fare_amount", "currency",
        F.when(is_update, "CANCELLED").otherwise(F.col("status")).alias("status"),
        "channel",
        F.when(is_update, "2001-09-02 09:00:00").otherwise(F.col("updated_ts")).alias("updated_ts"),
        F.when(is_update, SECOND_LOAD).otherwise(F.col("load_date")).alias("load_date"),
    )


def landing_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passenger extracts: a full first extract plus a second day of changes and re-sends.

    Every customer is in the first extract. Bookings of passengers in no extract (booking class 12,
    ids of their own ``U`` prefix) resolve to the unknown member.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    k = F.col("c_custkey")
    base_day = F.date_add(F.lit(PASSENGER_BASE_DATE).cast("date"), (k % 365).cast("int"))
    pid = F.concat(F.lit("P"), _lpad_key(k, 7))
    base_email = F.when(k % 37 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lower("c_name"), F.lit("@example.com"))
    )
    tiers = F.array(*[F.lit(t) for t in TIERS_BY_RESIDUE])
    base_tier = F.element_at(tiers, (k % 4 + 1).cast("int"))
    next_tier = F.element_at(tiers, ((k + 1) % 4 + 1).cast("int"))

    # arm 0 full extract, 1 tier change, 2 reverted, 3 unchanged re-send, 4 NULL -> value, 5 copy
    arms = F.array_compact(
        F.array(
            F.lit(0),
            F.when(k % 10 == 0, F.lit(1)),
            F.when(k % 30 == 0, F.lit(2)),
            F.when(k % 10 == 1, F.lit(3)),
            F.when((k % 37 == 0) & (k % 10).isin(2, 3, 4), F.lit(4)),
            F.when(k % 50 == 3, F.lit(5)),
        )
    )
    rows = c.withColumn("arm", F.explode(arms))
    arm = F.col("arm")
    full = arm == 0
    messy = full & (k % 15 == 0)
    day_offset = (
        F.when(arm == 1, 730).when(arm == 2, 1460).when(arm == 3, 900).when(arm == 4, 1000).otherwise(0)
    )
    return rows.select(
        F.when(full & (k % 200 == 7), "").otherwise(pid).alias("passenger_id"),
        F.when(messy, F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).otherwise(F.col("c_name")).alias("full_name"),
        F.when(messy, F.concat(F.lit(" "), F.upper(base_email), F.lit(" ")))
        .when(arm == 4, F.concat(pid, F.lit("@example.com")))
        .otherwise(base_email)
        .alias("email"),
        F.when(full & (k % 200 == 9), "PLATINUM").when(arm == 1, next_tier).otherwise(base_tier).alias("loyalty_tier"),
        F.concat(F.lit("N"), _s(F.col("c_nationkey"))).alias("home_airport"),
        F.when(full & (k % 200 == 11), "soon")
        .otherwise(_s(F.date_add(base_day, day_offset)))
        .alias("updated_at"),
        F.when(full, FIRST_LOAD).otherwise(SECOND_LOAD).alias("load_date"),
    )
