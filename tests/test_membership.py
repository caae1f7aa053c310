"""The filter-first anti-join equals a plain one, whatever the filter's size, and shuffles only what the filter lets through."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakesmith.operators.membership import filtered_anti_join, key_filter, split_by_filter


def _rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def tables(spark):
    """A child of which one key holds a third, with NULLs, repeated rows and clashing names; a parent with NULLs and repeats."""
    rows = [(None if i % 11 == 0 else 7 if i % 3 == 0 else i % 500, "abc"[i % 3] if i % 13 else None, i % 40) for i in range(6000)]
    child = spark.createDataFrame(rows, "k long, t string, word long").repartition(5)
    parents = [(None if i % 17 == 0 else i % 900, "abd"[i % 3], i) for i in range(0, 2000, 7)]
    return rows, child, parents, spark.createDataFrame(parents, "k long, t string, mask long")


@pytest.mark.parametrize("bits", [64, 640, 1 << 20])
def test_equals_brute_force_with_one_key_and_two(tables, bits):
    rows, child, parents, parent = tables
    known = {k for k, _, _ in parents if k is not None}
    assert _rows(filtered_anti_join(child, parent, [("k", "k")], bits)) == Counter(r for r in rows if r[0] not in known)
    pairs = {(k, t) for k, t, _ in parents if k is not None}
    got = filtered_anti_join(child, parent, [("k", "k"), ("t", "t")], bits)
    assert got.columns == child.columns
    assert _rows(got) == Counter(r for r in rows if None in r[:2] or r[:2] not in pairs)


def test_empty_tables(tables):
    _, child, _, parent = tables
    assert _rows(filtered_anti_join(child, parent.where(F.lit(False)), [("k", "k")])) == _rows(child)
    assert filtered_anti_join(child.where(F.lit(False)), parent, [("k", "k")]).count() == 0


def test_filter_is_bounded_and_lets_few_through(spark):
    parent = spark.range(100_000).select((F.col("id") * 10).alias("p"))
    child = spark.range(1_000_000).withColumnRenamed("id", "c")
    bits = 1 << 21
    assert key_filter(parent, ["p"], bits).count() <= bits // 64
    sure, possible = split_by_filter(child, parent, [("c", "p")], bits)
    n = possible.count()
    assert sure.count() + n == 1_000_000
    assert 100_000 <= n <= 110_000  # all with a parent, and about one in a hundred of the others
    assert sure.where("c % 10 = 0").count() == 0
    assert filtered_anti_join(child, parent, [("c", "p")], bits).count() == 900_000


def test_only_the_possible_branch_is_shuffled(spark, tables):
    _, child, _, parent = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = filtered_anti_join(child, parent, [("k", "k")])._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert plan.count("SortMergeJoin") == 1 and "LeftAnti" in plan
    above, below = plan.split("SortMergeJoin", 1)
    assert "BroadcastHashJoin" in above and "BroadcastHashJoin" in below
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_types_without_exact_hashes_are_refused(spark):
    child = spark.createDataFrame([(1, 1.0, "a")], "i int, d double, s string")
    parent = spark.createDataFrame([(1, 1.0, "a")], "l long, d double, s string")
    for pair in (("i", "l"), ("d", "d")):
        with pytest.raises(ValueError):
            filtered_anti_join(child, parent, [pair])
    with pytest.raises(ValueError):
        filtered_anti_join(child, parent, [("s", "s")], bits=32)
