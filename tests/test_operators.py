"""Operator semantics on small hand-made frames, checked against brute force or DuckDB."""

import datetime as dt
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lakesmith.functions.text import DECIMAL_SHAPE, INTEGER_SHAPE, ISO_DATE_TIME_SHAPE, guarded_cast
from lakesmith.operators.checks import overlapping_windows
from lakesmith.operators.classify import MissingAny, Negative, NotAccepted, NotInReference, classify
from lakesmith.operators.dedupe import dedupe_latest
from lakesmith.operators.pit import asof_lookup
from lakesmith.operators.scd2 import scd2

TRICKY = [
    "2024-06-02", "2024-6-2", "2024-06-02 09:00:00", "2024-06-02T09:00:00", "2024-06-02 09:00",
    "2024-06-02 24:00:00", "2024-06-02 09", "2024", "2024-06", "2024/06/02", "12:30", "epoch",
    "infinity", "2024-02-31", "2024-13-45", "yesterday", "2024-06-02 09:00:00Z", "2024-06-02 09:00:00+02:00",
    "0999-01-01", "2024-06-02 09:00:00.123456", "", "garbage-ts", "??",
    "12.345", "-25.00", "12,50", "abc", "1e2", ".5", "5.", "+3", "1_000", "99999999.99", "100000000",
    "12.7", "42", "-7", " 42", "n/a",
]
DUCK = {"timestamp_ntz": "TIMESTAMP", "date": "DATE", "decimal(10,2)": "DECIMAL(10,2)", "int": "INTEGER"}
SHAPES = {"timestamp_ntz": ISO_DATE_TIME_SHAPE, "date": ISO_DATE_TIME_SHAPE, "decimal(10,2)": DECIMAL_SHAPE, "int": INTEGER_SHAPE}


@pytest.mark.parametrize("type_name", list(DUCK))
def test_guarded_cast_agrees_with_duckdb(spark, type_name):
    df = spark.createDataFrame([(v,) for v in TRICKY], "v string")
    got = {r["v"]: r["c"] for r in df.select("v", guarded_cast("v", type_name).cast("string").alias("c")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in TRICKY])
    pat = SHAPES[type_name]
    rows = con.execute(
        f"SELECT v, CAST(CASE WHEN regexp_matches(v, '{pat}') THEN TRY_CAST(v AS {DUCK[type_name]}) END AS VARCHAR) FROM t"
    ).fetchall()
    assert got == dict(rows)


def test_first_reason_wins_in_rule_order(spark):
    routes = spark.createDataFrame([("A-B",), (None,)], "route_code string")
    df = spark.createDataFrame(
        [("1", -5.0, "BOGUS", "A-B"), ("2", 3.0, "BOGUS", "A-B"), ("3", 3.0, "OK", "X-Y"), ("4", 3.0, "OK", "A-B"), (None, -1.0, "OK", "A-B")],
        "id string, fare double, status string, route_code string",
    )
    rules = (
        MissingAny("malformed", columns=("id",)),
        Negative("negative", column="fare"),
        NotAccepted("status", column="status", values=("OK",)),
        NotInReference("route", column="route_code", reference=routes, ref_column="route_code"),
    )
    got = {r["id"]: r["reject_reason"] for r in classify(df, rules).collect()}
    # a NULL reference key must not make every route unknown (NOT IN trap)
    assert got == {"1": "negative", "2": "status", "3": "route", "4": None, None: "malformed"}


def test_dedupe_is_total_and_deterministic(spark):
    df = spark.createDataFrame(
        [("k", 2, "b"), ("k", 2, "a"), ("k", 1, "z"), ("j", None, "x"), ("j", 0, "y")], "key string, v int, other string"
    )
    got = {(r["key"], r["v"], r["other"]) for r in dedupe_latest(df, ["key"], [("v", True)]).collect()}
    assert got == {("k", 2, "a"), ("j", 0, "y")}


def _d(s):
    return dt.date.fromisoformat(s)


def test_scd2_collapses_resends_and_keeps_reverts(spark):
    rows = [
        ("p1", "A", None, _d("2020-01-01")),
        ("p1", "A", None, _d("2020-02-01")),  # identical re-send (NULL = NULL): no version
        ("p1", "B", None, _d("2020-03-01")),
        ("p1", "A", None, _d("2020-04-01")),  # revert: a version of its own
        ("p1", "A", "x@y", _d("2020-05-01")),  # NULL -> value: a change
        ("p2", "C", "c", _d("2021-01-01")),
    ]
    h = spark.createDataFrame(rows, "id string, tier string, email string, updated date")
    v = scd2(h, ["id"], ["tier", "email"], "updated", surrogate="sk").orderBy("id", "valid_from").collect()
    got = [(r["id"], r["tier"], r["email"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"]) for r in v]
    assert got == [
        ("p1", "A", None, "1900-01-01", "2020-03-01", False),
        ("p1", "B", None, "2020-03-01", "2020-04-01", False),
        ("p1", "A", None, "2020-04-01", "2020-05-01", False),
        ("p1", "A", "x@y", "2020-05-01", "9999-12-31", True),
        ("p2", "C", "c", "1900-01-01", "9999-12-31", True),
    ]
    assert all(r["first_seen_date"] == (_d("2020-01-01") if r["id"] == "p1" else _d("2021-01-01")) for r in v)


def test_asof_lookup_equals_brute_force(spark):
    rnd = random.Random(7)
    hist = [(f"k{rnd.randrange(5)}", _d("2020-01-01") + dt.timedelta(days=rnd.randrange(60)), f"v{i}") for i in range(80)]
    # one row per (key, time) as the operator expects a de-duplicated history
    hist = list({(k, t): (k, t, v) for k, t, v in hist}.values())
    probes = [(i, f"k{rnd.randrange(6)}", _d("2020-01-01") + dt.timedelta(days=rnd.randrange(70))) for i in range(300)]
    # a hot key: many probes on one key and one date
    probes += [(1000 + i, "k1", _d("2020-02-01")) for i in range(200)]
    h = spark.createDataFrame(hist, "key string, t date, val string")
    p = spark.createDataFrame(probes, "id int, key string, pt date")
    got = {r["id"]: r["asof_val"] for r in asof_lookup(p, h, ["key"], "pt", "t", ["val"]).collect()}
    expected = {}
    for i, k, t in probes:
        cands = [(ht, v) for hk, ht, v in hist if hk == k and ht <= t]
        expected[i] = max(cands)[1] if cands else None
    assert got == expected


def test_overlap_sweep_counts_pairs_like_a_self_join(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(150):
        a = rnd.randrange(100)
        rows.append((f"k{rnd.randrange(6)}", a, a + 1 + rnd.randrange(20), f"s{i:04d}"))
    df = spark.createDataFrame(rows, "key string, f int, t int, sk string")
    got = overlapping_windows(df, ["key"], "f", "t", "sk", "x").first()["violations"]
    brute = sum(
        1
        for a in rows for b in rows
        if a[0] == b[0] and a[3] < b[3] and a[1] < b[2] and b[1] < a[2]
    )
    assert got == brute


def test_rule_order_is_the_documented_reason_order(spark):
    from lakesmith.plans import silver as S

    routes = spark.createDataFrame([("A-B",)], "route_code string")
    # The reasons in the order in which they apply.
    assert [r.reason for r in S.booking_rules(routes)] == [
        "malformed_value", "missing_passenger_id", "negative_fare", "invalid_status", "unknown_route",
    ]
    assert [r.reason for r in S.PASSENGER_RULES] == ["malformed_value", "missing_passenger_id", "invalid_loyalty_tier"]


def test_ranged_scd2_equals_window_scd2_with_a_hot_key(spark):
    from lakesmith.operators.scd2 import scd2_ranged

    rnd = random.Random(11)
    rows = {}
    base = dt.datetime(2024, 1, 1)
    for i in range(1500):
        k = "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}"  # one key holds a third of the rows
        t = base + dt.timedelta(seconds=rnd.randrange(10**6), microseconds=rnd.randrange(10**6))
        rows[(k, t)] = (k, rnd.choice(["a", "b", None]), rnd.choice(["x", "y"]), t)
    h = spark.createDataFrame(list(rows.values()), "id string, tier string, kind string, ts timestamp_ntz")
    start, end = dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31)
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    a = scd2(h, ["id"], ["tier", "kind"], "ts", open_start=start, open_end=end)
    b = scd2_ranged(h, ["id"], ["tier", "kind"], "ts", open_start=start, open_end=end, version_text=fmt)
    cols = ["id", "tier", "kind", "first_seen_date", "valid_from", "valid_to", "is_current"]
    from collections import Counter

    expected = Counter(tuple(r) for r in a.select(*cols).collect())
    assert Counter(tuple(r) for r in b.select(*cols).collect()) == expected
    assert sum(expected.values()) > 100
    assert b.select("surrogate_key").distinct().count() == b.count()


def test_ranged_asof_equals_brute_force_with_a_hot_key(spark):
    from lakesmith.operators.pit import asof_lookup_ranged

    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    hist = {}
    for i in range(600):
        k = "hot" if i % 3 == 0 else f"k{rnd.randrange(10)}"
        t = t0 + dt.timedelta(seconds=rnd.randrange(5000))
        hist[(k, t)] = (k, t, rnd.choice(["a", "b", None]))
    hist = list(hist.values())
    probes = [(i, "hot" if i % 2 else f"k{rnd.randrange(12)}", t0 + dt.timedelta(seconds=rnd.randrange(5200))) for i in range(900)]
    h = spark.createDataFrame(hist, "key string, t timestamp_ntz, val string")
    p = spark.createDataFrame(probes, "id int, key string, pt timestamp_ntz")
    got = {r["id"]: r["asof_val"] for r in asof_lookup_ranged(p, h, ["key"], "pt", "t", ["val"]).collect()}
    expected = {}
    for i, k, t in probes:
        cands = [(ht, v) for hk, ht, v in hist if hk == k and ht <= t]
        expected[i] = max(cands, key=lambda c: c[0])[1] if cands else None
    assert got == expected
    assert sum(v is not None for v in got.values()) > 300


def test_long_keys_stay_whole(spark):
    from lakesmith.sources.landing import _lpad_key

    rows = spark.createDataFrame([(7,), (12_345_678_901,), (12_345_678_902,)], "k long")
    assert [r[0] for r in rows.select(_lpad_key(F.col("k"), 9)).collect()] == ["000000007", "12345678901", "12345678902"]


def test_null_part_gives_null_key(spark):
    from lakesmith.functions.keys import surrogate_key

    rows = spark.createDataFrame([("a", "b"), (None, "b")], "x string, y string")
    assert [r[0] for r in rows.select(surrogate_key("x", "y")).collect()] == [hashlib.md5(b"a|b").hexdigest(), None]


def test_newline_is_no_part_of_a_date(spark):
    from lakesmith.functions.text import guarded_cast

    rows = spark.createDataFrame([("2024-06-01\n",), ("2024-06-01",)], "x string")
    assert [r[0] is None for r in rows.select(guarded_cast("x", "date")).collect()] == [True, False]


def test_asof_ranged_with_probes_far_after_the_history(spark):
    """Partitions of probes alone pass on what came before them, at any partition count."""
    from lakesmith.operators.pit import asof_lookup_ranged

    history = spark.createDataFrame([("k", 1, "v0"), ("k", 2, "v1")], "key string, t int, v string")
    probes = spark.range(10, 2010).select(F.lit("k").alias("key"), F.col("id").cast("int").alias("p"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for slices in ("1", "8", "100"):
            spark.conf.set("spark.sql.shuffle.partitions", slices)
            found = asof_lookup_ranged(probes, history, ["key"], "p", "t", ["v"])
            assert {(r[0], r[1]) for r in found.groupBy("asof_v").count().collect()} == {("v1", 2000)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_interval_merge_of_a_long_history(spark):
    """One key with 10,000 versions and 100,000 facts, and small ones with gaps, empty windows and NULLs."""
    import bisect
    import time

    from lakesmith.operators.pit import interval_merge_join

    starts = list(range(5, 300_005, 30))
    windows = [("hot", s, s + 20 + (s % 3) * 5, f"v{s}") for s in starts]
    windows += [("a", 10, 20, "a1"), ("a", 20, 20, "empty"), ("a", 30, 1000, "a2"), ("b", 0, 5, "b1"), (None, 0, 1000, "none")]
    facts = [("hot", (i * 7919) % 300_100, i) for i in range(100_000)]
    facts += [(k, t, 200_000 + i) for i, (k, t) in enumerate([("a", 9), ("a", 10), ("a", 19), ("a", 20), ("a", 29), ("a", 30), ("a", 999), ("a", 1000), ("b", 4), ("b", 5), ("c", 1), (None, 3), ("a", None)] * 2)]
    v = spark.createDataFrame(windows, "vk string, valid_from long, valid_to long, name string")
    f = spark.createDataFrame(facts, "fk string, t long, n long")
    began = time.time()
    got = {r.n: (r.fk, r.t, r.name) for r in interval_merge_join(f, v, "fk", "t", "vk").collect()}
    assert time.time() - began < 60 and len(got) == len(facts)
    by_key = {}
    for k, lo, hi, name in windows:
        if k is not None and lo < hi:
            by_key.setdefault(k, []).append((lo, hi, name))
    for k, t, n in facts:
        own = by_key.get(k, [])
        at = bisect.bisect_right(own, (t, float("inf"), "")) - 1 if t is not None else -1
        assert got[n] == (k, t, own[at][2] if at >= 0 and t < own[at][1] else None)


def test_slices_grow_with_the_bytes(spark, tmp_path):
    from lakesmith.sources import files

    spark.range(200_000).selectExpr("id", "sha2(cast(id as string), 256) AS h").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    size = files.input_bytes(df.where("id > 5").select("h"))
    assert size > 5_000_000 and files.slice_count(df) == 8
    assert files.slice_count(df, slice_bytes=size // 20) >= 20
    assert files.input_bytes(spark.range(5)) == 0
