"""Lines with a field too many or too few: kept whole, rejected first, counted."""

from dataclasses import replace

from lakesmith.operators.accounting import account_by_key, identity, identity_by_key
from lakesmith.operators.classify import quarantine
from lakesmith.plans import silver as S
from lakesmith.plans import warehouse as W
from lakesmith.session import materialize, scratch_path
from lakesmith.sources.files import read_parquet, read_text_csv
from lakesmith.sources.landing import BOOKING_COLUMNS, booking_lines
from tests.conftest import SF_SMALL

HEADER = ",".join(BOOKING_COLUMNS)
GOOD = 'B1,P1,N0-N5,1995-01-01 01:15:00,1995-02-01,10.00,USD,FLOWN,WEB,1995-01-01 01:15:00'
QUOTED = 'B2,P1,N0-N5,1995-01-01 01:15:00,1995-02-01,"12,50",USD,FLOWN,WEB,1995-01-01 01:15:00'
WIDE, SHORT = GOOD.replace("B1", "B3") + ",more", "B4, P1 ,N0-N5"


def _extract(spark, tmp_path):
    folder = tmp_path / "load_date=2001-09-01"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([HEADER, GOOD, QUOTED, WIDE, SHORT, GOOD, ""]))
    (folder / "empty.csv").write_text(HEADER + "\n")
    return read_text_csv(spark, str(tmp_path), BOOKING_COLUMNS, ["load_date"], record_column=S.RECORD)


def test_only_lines_of_the_wrong_width_are_kept_whole(spark, tmp_path):
    rows = _extract(spark, tmp_path).select("booking_id", S.RECORD, "load_date").collect()
    assert sorted((r[0], r[1]) for r in rows if r[1]) == [("B3", WIDE), ("B4", SHORT)]
    assert sorted(r[0] for r in rows) == ["B1", "B1", "B2", "B3", "B4"]
    assert {r["load_date"] for r in rows} == {"2001-09-01"}


def test_malformed_lines_are_the_first_reason_and_counted(spark, tmp_path):
    inputs = replace(S.landing_inputs(spark, SF_SMALL), bookings=_extract(spark, tmp_path))
    classified = materialize(S.classify_bookings(inputs), "lines")
    got = {(r["metric"], r["reason"]): r["value"] for r in account_by_key("b", classified, S.BOOKING_KEY).collect()}
    assert got == {
        ("landing_rows", None): 5, ("silver_rows", None): 1, ("rejected", None): 3, ("duplicates_removed", None): 1,
        ("rejected_by_reason", "malformed_line"): 2, ("rejected_by_reason", "malformed_value"): 1,
    }
    lane = quarantine(classified, BOOKING_COLUMNS, keep=S.kept_columns(classified)).collect()
    assert {r["booking_id"]: r[S.RECORD] for r in lane} == {"B2": None, "B3": WIDE, "B4": SHORT}


def test_build_silver_writes_the_lane(spark):
    inputs = S.landing_inputs(spark, SF_SMALL)
    path = scratch_path(spark, "test-lines")
    booking_lines(inputs.bookings).write.partitionBy("load_date").text(path)
    read = read_text_csv(spark, path, BOOKING_COLUMNS, ["load_date"], record_column=S.RECORD, header=False)
    paths, _ = W.build_silver(spark, replace(inputs, bookings=read), scratch_path(spark, "test-lane"))
    value = {(r["metric"], r["reason"]): r["value"] for r in W.read_metrics_json(spark, paths.metrics).where("dataset = 'bookings'").collect()}
    assert value["landing_rows", None] == inputs.bookings.count()
    assert value["landing_rows", None] == sum(value[m, None] for m in ("silver_rows", "rejected", "duplicates_removed"))
    lane = read_parquet(spark, paths.quarantine_bookings)
    assert lane.where("reject_reason = 'malformed_line'").count() == value["rejected_by_reason", "malformed_line"] > 0
    assert lane.where(f"({S.RECORD} IS NOT NULL) <> (reject_reason = 'malformed_line')").isEmpty()


def test_one_pass_identity_equals_the_two_pass_one(spark):
    inputs = S.landing_inputs(spark, SF_SMALL)
    classified = materialize(S.classify_bookings(inputs), "identity")
    want = identity("bookings", classified, S.dedupe_bookings(classified))
    got = identity_by_key("bookings", classified, S.BOOKING_KEY)
    assert got.select(*want.columns).collect() == want.collect()
    assert got.first()["balanced"]
    scans = got._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert scans == 1
    # no rows: every count is zero in both
    empty = classified.limit(0)
    assert identity_by_key("b", empty, S.BOOKING_KEY).first()[1:5] == identity("b", empty, S.dedupe_bookings(empty)).first()[1:5]
