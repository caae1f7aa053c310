"""Parity by bucket sums equals the plain symmetric difference."""

import random

import pytest
from pyspark.sql import functions as F

from lakesmith.operators.parity import bucket_sums, bucketed_difference, symmetric_difference
from tests.conftest import SF_SMALL

SCHEMA = "a string, b string, n double"


def _same(spark, left, right, buckets):
    left, right = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    want = symmetric_difference(left, right, "t").collect()
    got = bucketed_difference(left, right, "t", buckets)
    assert got.columns == symmetric_difference(left, right, "t").columns
    assert got.collect() == want
    return want[0]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_equals_the_plain_difference(spark, buckets):
    rng = random.Random(buckets)
    row = lambda: (rng.choice([None, "", "x", "y"]), rng.choice([None, "", "x"]), rng.choice([None, 0.0, -0.0, float("nan"), 1.5]))
    left = [row() for _ in range(300)] + [("hot", None, 1.0)] * 200
    right = rng.sample(left, 400) + [row() for _ in range(30)]
    found = _same(spark, left, right, buckets)
    assert found["only_left"] > 0 and found["only_right"] > 0


def test_nulls_that_change_places_and_repeats_are_seen(spark):
    assert _same(spark, [("x", None, 1.0)], [(None, "x", 1.0)], 64)["only_left"] == 1
    assert _same(spark, [("x", "y", 1.0)] * 3, [("x", "y", 1.0)] * 2, 64)["only_left"] == 1
    assert _same(spark, [("x", "y", 1.0), ("x", "z", 1.0)], [("x", "z", 1.0), ("x", "y", 1.0)], 64)["only_left"] == 0


def test_empty_tables(spark):
    assert _same(spark, [], [], 64)["left_rows"] == 0
    assert _same(spark, [], [("x", None, None)], 64)["only_right"] == 1


def test_only_differing_buckets_are_grouped_by_row(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderstatus")
    one = orders.agg(F.max("o_orderkey")).first()[0]
    other = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == one, "?").otherwise(F.col("o_orderstatus")))
    sums = bucket_sums(orders, other).where("NOT same").collect()
    assert 1 <= len(sums) <= 2 and sum(r["l"] for r in sums) < 10
    assert bucketed_difference(orders, other, "t").select("only_left", "only_right").first() == (1, 1)
    assert bucket_sums(orders, orders.repartition(5)).where("NOT same").isEmpty()
