"""Late loads: each table after each load equals a rebuild; what a load does not touch keeps its files."""

import copy
import glob
import os

import pytest
from pyspark.sql import functions as F

from lakesmith.operators.scd2_merge import narrowed, segments
from lakesmith.plans import late_loads as L
from lakesmith.plans import silver as S
from lakesmith.plans import star as T
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def files(root, table):
    return {os.path.relpath(p, root): os.path.getmtime(p) for p in glob.glob(f"{root}/{table}/*/*.parquet")}


def rebuilt(inputs, landed, bookings, dim_r):
    only = S.SilverInputs(inputs.routes, inputs.bookings, landed)
    stg_p = T.stg_passengers(S.silver_passengers(only))
    dim_p = T.build_dim_passenger(stg_p)
    fact = T.build_fact_bookings(bookings, dim_p, dim_r)
    return dim_p, fact, T.build_mart_revenue_by_loyalty_tier(fact, dim_p, T.booking_calendar(bookings))


def test_tables_after_each_load_equal_a_rebuild(spark, tmp_path):
    inputs = S.landing_inputs(spark, SF_SMALL)
    landing = str(tmp_path / "landed")
    inputs.passengers.withColumn("arrives", F.pmod(F.xxhash64(*inputs.passengers.columns), F.lit(3))).write.parquet(landing)
    landed = spark.read.parquet(landing)
    late = (F.col("arrives") == 1) & (F.col("passenger_id") < "P0000020")
    deliveries = [landed.where("arrives = 0"), landed.where(late), landed.where(late), landed.where(~late & (F.col("arrives") > 0)), landed.limit(0)]
    bookings = spark.read.parquet(_written(T.stg_bookings(S.silver_bookings(inputs)), tmp_path / "stg_b"))
    dim_r = T.build_dim_route(T.stg_routes(S.silver_routes(inputs)))
    root = str(tmp_path / "tables")
    state = L.LateLoads(spark, root, bookings, dim_r)
    seen = None
    for k, delivery in enumerate(deliveries):
        delivery = delivery.drop("arrives")
        seen = delivery if seen is None else seen.unionByName(delivery)
        before = {t: files(root, t) for t in ("history", "dimension", "fact", "tier_state")}
        if k == 0:
            state.first(S.silver_passengers(S.SilverInputs(inputs.routes, inputs.bookings, delivery)))
        else:
            if k == 3:  # crashes before and after each table is overwritten; the same call again goes on
                for table in ("history", "dimension", "fact", "tier_state"):
                    for after in (False, True):
                        with pytest.raises(RuntimeError, match="crash"):
                            crashing(state, table, after).merge(delivery)
            changed = state.merge(delivery)
            for table, by in (("history", "slice"), ("dimension", "slice"), ("fact", "month"), ("tier_state", "month")):
                touched = {f"{by}={p}" for p in changed.get(table, [])}
                kept = {p: m for p, m in before[table].items() if p.split("/")[1] not in touched and k != 3}
                now = files(root, table)
                assert all(now.get(p) == m for p, m in kept.items()), (k, table)
            if k == 1:
                assert 0 < len(changed["fact"]) and len(changed["dimension"]) < L.SLICES
            if k in (2, 4):  # the same rows again, and none: nothing moves
                assert not changed.get("fact") and not changed.get("tier_state")
        dim_p, fact, mart = rebuilt(inputs, seen, bookings, dim_r)
        assert rows(state.dimension()) == rows(dim_p), k
        assert rows(state.fact()) == rows(fact), k
        assert rows(state.mart()) == rows(mart), k


def crashing(state, table, after):
    """The same tables with a writer that fails at one of them."""
    other = copy.copy(state)

    def write(df, name, by):
        rows = L.LateLoads._write(other, df, name, by) if name != table or after else L.LateLoads._stage(other, df, name)
        if name == table:
            raise RuntimeError("crash")
        return rows

    other._write = write
    return other


def _written(df, path):
    df.write.parquet(str(path))
    return str(path)


def test_segments_are_the_days_with_another_version(spark):
    import datetime as dt
    import random

    random.seed(5)
    days = [dt.date(2000, 1, 1) + dt.timedelta(d) for d in range(12)]

    def windows(names):
        out = []
        for key in "abcd":
            cuts = sorted(random.sample(days, random.randint(1, 5)))
            out += [(key, lo, hi, random.choice(names)) for lo, hi in zip(cuts, [*cuts[1:], dt.date(9999, 12, 31)], strict=True)]
            if cuts[0] != days[0]:
                out.append((key, days[0], cuts[0], "z"))
        return out

    old, new = windows("xy"), windows("xyz")
    old = [w for w in old if w[0] != "d"]  # a new key
    frame = lambda w: spark.createDataFrame(w, "k string, valid_from date, valid_to date, name string")
    got = segments(frame(old), frame(new), "k", ["name"]).collect()
    at = lambda w, k, d: next((n for key, lo, hi, n in w if key == k and lo <= d < hi), None)
    for k in "abcd":
        for d in days:
            found = [(r.old and r.old.name, r.new.name) for r in got if r.k == k and r.seg_from <= d < r.seg_to]
            want = (at(old, k, d), at(new, k, d))
            assert found == ([want] if want[0] != want[1] else []), (k, d)


@pytest.mark.parametrize("name", ["incremental_dim_passenger", "incremental_fact_bookings", "incremental_mart_loyalty_tier"])
def test_registered(entry, name):
    assert name in entry.queries() and name in entry.oracle_sql()


def test_segments_hold_only_what_is_asked_of_a_version(spark):
    kind = "struct<k:bigint,tier:string,email:string>"
    changes = spark.createDataFrame([("p", 1, 2, None, (7, "BLUE", "m")), ("p", 2, 3, (6, None, "m"), (7, "BLUE", "n"))], f"who string, seg_from int, seg_to int, old {kind}, new {kind}")
    got = narrowed(changes, "who", ["k", "tier"]).orderBy("seg_from").collect()
    assert [(r.old and tuple(r.old), tuple(r.new)) for r in got] == [(None, (7, "BLUE")), ((6, None), (7, "BLUE"))]


def test_steps_of_a_merge_that_are_read_twice_are_written_once(spark, tmp_path):
    """The touched keys' versions and the mart's signed rows."""
    inputs = S.landing_inputs(spark, SF_SMALL)
    state = L.LateLoads(spark, str(tmp_path / "t"), T.stg_bookings(S.silver_bookings(inputs)), T.build_dim_route(T.stg_routes(S.silver_routes(inputs))))
    first, late = (inputs.passengers.where(f"load_date = '{d}'") for d in ("2001-09-02", "2001-09-01"))
    state.first(S.silver_passengers(S.SilverInputs(inputs.routes, inputs.bookings, first)))
    state.merge(late)
    assert {"versions-1", "delta-1"} <= set(os.listdir(tmp_path / "t" / "_work"))
    assert set(spark.read.parquet(str(tmp_path / "t" / "_work" / "moved-1")).schema["new"].dataType.names) == {"passenger_key", "loyalty_tier"}
