"""Metrics that a write observes equal those counted from its table, also where tasks are run again or nothing is written."""

import subprocess
import sys
from dataclasses import replace

from pyspark.sql import functions as F

from lakesmith.operators import accounting as A
from lakesmith.plans import silver as S
from lakesmith.plans import warehouse as W
from lakesmith.session import scratch_path
from lakesmith.sources.files import read_parquet, write_parquet
from tests.conftest import SF_SMALL


def _metrics(spark, inputs):
    paths, (bookings, passengers, _) = W.build_silver(spark, inputs, scratch_path(spark, "test-observed"))
    return paths, bookings, passengers, sorted(W.read_metrics_json(spark, paths.metrics).collect(), key=str)


def test_observed_metrics_equal_a_pass_over_the_written_tables(spark):
    paths, bookings, passengers, seen = _metrics(spark, S.landing_inputs(spark, SF_SMALL))
    counted = A.row_count_metric("routes", "silver_rows", read_parquet(spark, paths.routes))
    for name, silver in (("bookings", bookings), ("passengers", passengers)):
        counted = counted.unionByName(A.account(name, read_parquet(spark, paths.staged(f"classified_{name}")), silver))
    assert seen == sorted(counted.collect(), key=str)


def test_no_rows_are_observed_as_zero(spark):
    inputs = S.landing_inputs(spark, SF_SMALL)
    _, _, _, seen = _metrics(spark, replace(inputs, bookings=inputs.bookings.where(F.lit(False))))
    of_bookings = {r.metric: r.value for r in seen if r.dataset == "bookings"}
    assert of_bookings == {"landing_rows": 0, "silver_rows": 0, "rejected": 0, "duplicates_removed": 0}


def test_partitioned_write_counts_rows_once_though_its_ranges_are_sampled(spark):
    rows = spark.range(5000, numPartitions=6).select("id", (F.col("id") % 7).alias("part"))
    seen = write_parquet(
        rows, scratch_path(spark, "test-observed-ranges"), partition_columns=["part"], cluster_by=["id"],
        metrics=[F.count(F.lit(1)).alias("n"), F.sum("id").alias("total"), F.count_if(F.col("part") == 3).alias("threes")],
    )
    assert seen == {"n": 5000, "total": sum(range(5000)), "threes": len(range(3, 5000, 7))}


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from lakesmith.sources.files import write_parquet
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.driver.host", "127.0.0.1").getOrCreate())
def late_failure(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt fails after its rows")
rows = spark.range(1000, numPartitions=5).mapInArrow(late_failure, "id long")
seen = write_parquet(rows, sys.argv[1], metrics=[F.count(F.lit(1)).alias("n"), F.sum("id").alias("total")])
assert spark.read.parquet(sys.argv[1]).count() == 1000
print("seen", seen["n"], seen["total"])
spark.stop()
"""


def test_a_task_that_is_run_again_is_counted_once(tmp_path):
    """A session of its own: tasks of the tests' session may fail only once."""
    done = subprocess.run(
        [sys.executable, "-c", RETRIED, str(tmp_path / "out")], capture_output=True, text=True, timeout=240, cwd=sys.path[0] or "."
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert f"seen 1000 {sum(range(1000))}" in done.stdout
