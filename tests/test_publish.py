"""End-to-end publish job: written layers, metrics sink, pointer, idempotent rebuild."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lakesmith.operators.checks import QualityGateError
from lakesmith.plans import silver as S
from lakesmith.plans import warehouse as W
from lakesmith.session import scratch_path
from lakesmith.sources.files import read_parquet
from tests.conftest import SF_SMALL


def test_publish_and_rebuild(spark):
    inputs = S.landing_inputs(spark, SF_SMALL)
    root = scratch_path(spark, "test-wh")
    first = W.publish(spark, inputs, root, run_id="r1")
    m1 = sorted(tuple(r) for r in W.read_metrics_json(spark, W.SilverPaths(first["silver"]).metrics).collect())
    second = W.publish(spark, inputs, root, run_id="r2")
    m2 = sorted(tuple(r) for r in W.read_metrics_json(spark, W.SilverPaths(second["silver"]).metrics).collect())
    assert m1 == m2
    assert W.current_run(spark, root) == second["run_dir"] != first["run_dir"]
    metrics = {(d, m, r): v for d, m, r, v in m2}
    fact = read_parquet(spark, f"{second['run_dir']}/fact_bookings")
    assert fact.count() == metrics[("bookings", "silver_rows", None)]
    assert metrics[("bookings", "landing_rows", None)] == (
        metrics[("bookings", "silver_rows", None)] + metrics[("bookings", "rejected", None)]
        + metrics[("bookings", "duplicates_removed", None)]
    )
    assert spark.sql("SELECT count(*) AS n FROM fact_bookings").first()["n"] == fact.count()
    silver = read_parquet(spark, W.SilverPaths(second["silver"]).bookings)
    assert "booking_date" in silver.columns and silver.count() == fact.count()


def test_failed_gate_leaves_the_earlier_run(spark, monkeypatch):
    inputs = S.landing_inputs(spark, SF_SMALL)
    root = scratch_path(spark, "test-wh-gate")
    with pytest.raises(LookupError):
        W.current_run(spark, root)
    first = W.publish(spark, inputs, root, run_id="good")
    rows = read_parquet(spark, W.SilverPaths(first["silver"]).bookings).count()
    real = W.Q.dq_summary
    monkeypatch.setattr(W.Q, "dq_summary", lambda star: real(star).withColumn("violations", F.lit(1).cast("bigint")))
    bad = replace(inputs, bookings=inputs.bookings.where("passenger_id like 'P%1'"))
    with pytest.raises(QualityGateError):
        W.publish(spark, bad, root, run_id="bad")
    assert W.current_run(spark, root) == first["run_dir"]
    assert read_parquet(spark, W.SilverPaths(first["silver"]).bookings).count() == rows
    with pytest.raises(ValueError):
        W.publish(spark, inputs, root, run_id="good")


def test_names_in_the_catalog_switch_only_after_the_gate(spark, monkeypatch):
    inputs = S.landing_inputs(spark, SF_SMALL)
    root, name = scratch_path(spark, "test-catalog"), "test_catalog"
    few = replace(inputs, bookings=inputs.bookings.where("load_date = '2001-09-01'"))
    read = lambda table: spark.sql(f"SELECT count(*) AS n FROM {name}.{table}").first()["n"]
    W.publish(spark, few, root, run_id="r_1", database=name)
    before = read("fact_bookings")
    with pytest.raises(ValueError):
        W.publish(spark, few, root, run_id="no-name", database=name)
    real = W.Q.dq_summary
    monkeypatch.setattr(W.Q, "dq_summary", lambda star: real(star).withColumn("violations", F.lit(1).cast("bigint")))
    with pytest.raises(QualityGateError):
        W.publish(spark, inputs, root, run_id="r_bad", database=name)
    assert read("fact_bookings") == before
    assert not spark.catalog.tableExists(f"{name}.fact_bookings__r_bad")
    monkeypatch.setattr(W.Q, "dq_summary", real)
    second = W.publish(spark, inputs, root, run_id="r_2", database=name)
    after = read_parquet(spark, f"{second['run_dir']}/fact_bookings").count()
    assert read("fact_bookings") == read("fact_bookings__r_2") == after > before
    assert read("fact_bookings__r_1") == before  # an earlier run stays readable by its name
    W.register_tables(spark, root, "r_2", second["run_dir"], name)  # repeated without harm
    assert read("fact_bookings") == after
