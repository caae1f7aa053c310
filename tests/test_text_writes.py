"""A partitioned CSV write splits one partition value across tasks, and gives the rows back as they were."""

import glob

import pytest
from pyspark.sql import functions as F

from lakesmith.sources import files


@pytest.mark.parametrize("days", [["d1"], ["d1", "d2"]])
def test_one_partition_value_is_split_across_tasks(spark, tmp_path, days):
    rows = spark.range(4000).select(
        F.concat(F.lit(" "), F.col("id").cast("string")).alias("a"), F.when(F.col("id") % 3 > 0, F.lit('x,"y')).alias("b"),
        F.element_at(F.array(*map(F.lit, days)), (F.col("id") % len(days) + 1).cast("int")).alias("day"),
    )
    path = str(tmp_path / "csv")
    files.write_text_csv(rows, path, ["day"])
    sizes = [sum(1 for _ in open(p)) - 1 for p in glob.glob(f"{path}/day=*/*.csv")]
    assert sum(sizes) == 4000
    assert max(sizes) < 4000 / len(days) / 2
    back = files.read_text_csv(spark, path, ["a", "b"], ["day"])
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_rows_without_key_and_equal_rows_all_stay(spark, tmp_path):
    rows = spark.createDataFrame([(None, "x", "d1")] * 50 + [("k", None, "d1")] * 50 + [("k", "x", None)] * 3, "a string, b string, day string")
    path = str(tmp_path / "csv")
    files.write_text_csv(rows, path, ["day"])
    count = lambda df: {(r.a, r.b): r["count"] for r in df.groupBy("a", "b").count().collect()}
    assert count(files.read_text_csv(spark, path, ["a", "b"], ["day"])) == count(rows) == {(None, "x"): 50, ("k", None): 50, ("k", "x"): 3}


def test_text_slices_follow_the_bytes_scanned(spark, tmp_path, monkeypatch):
    spark.range(100_000).select(F.col("id").cast("string").alias("a"), F.lit("d").alias("day")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(files, "TEXT_SLICE_BYTES", files.input_bytes(df) // 20)
    files.write_text_csv(df, str(tmp_path / "csv"), ["day"])
    assert len(glob.glob(f"{tmp_path}/csv/day=d/*.csv")) > 15
