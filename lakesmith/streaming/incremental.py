"""Incremental silver bookings with Structured Streaming.

New landing folders (``load_date=D/*.csv``) are picked up by a file stream; every micro-batch is
merged into the existing silver table by ``foreachBatch``:

1. cleanse + classify the batch (routes reference read from the written silver routes) and stage
   it once below the checkpoint folder (the batch is read several times afterwards);
2. write the batch's rejects to ``quarantine/epoch=<id>`` (overwrite: a replayed epoch rewrites
   the same folder);
3. affected keys = booking ids accepted in the batch, whose latest versions are staged once; their current silver rows are read with a
   semi-join behind a range filter on ``booking_id``, which prunes row groups by their statistics
   (files are range-clustered on it), staged once, unioned with the new versions and de-duplicated with the same
   rule as the full rebuild;
4. affected dates = old and new booking dates of the affected keys, staged too; those partitions are rebuilt
   (untouched rows of the date + the new latest versions) and staged with the list of the dates
   that the batch leaves empty;
5. the staged partitions are written with *dynamic* partition overwrite, so every other date is
   left as it is, and the folders of emptied dates are removed.

Step 4 is a redo log. An overwrite removes old files before the new ones stand, so a crash in step 5
can leave silver without them; the replayed epoch then finds its staged partitions complete and
only repeats step 5, without reading silver. The merged table equals a full rebuild over the same
landing folders (the registered query ``incremental_silver_bookings`` is checked against the oracle
of the full rebuild).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.classify import classify, quarantine
from ..operators.cleanse import cleanse
from ..operators.dedupe import dedupe_latest
from ..plans import silver as S
from ..sources.files import slice_count, text_schema
from ..sources.landing import BOOKING_COLUMNS


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _path(spark, path)
    return fs.exists(at)


def merge_bookings_batch(
    batch: DataFrame, epoch_id: int, routes_path: str, silver_path: str, quarantine_path: str, work_dir: str
) -> None:
    spark = batch.sparkSession
    rebuilt_path = os.path.join(work_dir, f"rebuilt/epoch={epoch_id}")
    emptied_path = os.path.join(work_dir, f"emptied/epoch={epoch_id}")
    if not _exists(spark, os.path.join(emptied_path, "_SUCCESS")):  # written last
        _stage(batch, epoch_id, routes_path, silver_path, quarantine_path, work_dir, rebuilt_path, emptied_path)
    _write_silver(spark.read.parquet(rebuilt_path), silver_path)
    for row in spark.read.parquet(emptied_path).collect():  # dates, at most one for each partition folder of silver
        fs, at = _path(spark, os.path.join(silver_path, f"booking_date={row['booking_date']}"))
        fs.delete(at, True)


def _stage(
    batch: DataFrame, epoch_id: int, routes_path: str, silver_path: str, quarantine_path: str, work_dir: str,
    rebuilt_path: str, emptied_path: str,
) -> None:
    """The rebuilt partitions and the emptied dates of one batch; silver is read, not written."""
    spark = batch.sparkSession
    routes = spark.read.parquet(routes_path)
    classified = classify(cleanse(batch, S.BOOKING_SPEC, keep=["load_date"]), S.booking_rules(routes))
    staged_path = os.path.join(work_dir, f"classified/epoch={epoch_id}")
    classified.write.mode("overwrite").parquet(staged_path)
    cb = spark.read.parquet(staged_path)

    quarantine(cb, BOOKING_COLUMNS).write.mode("overwrite").parquet(os.path.join(quarantine_path, f"epoch={epoch_id}"))

    new_latest = S.dedupe_bookings(cb).select(*S.SILVER_BOOKING_COLUMNS)  # one row a key
    if not _exists(spark, silver_path):
        new_latest.write.mode("overwrite").parquet(rebuilt_path)
        new_latest.select("booking_date").limit(0).write.mode("overwrite").parquet(emptied_path)
        return

    def written(df: DataFrame, name: str) -> DataFrame:
        path = os.path.join(work_dir, f"{name}/epoch={epoch_id}")
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    old = spark.read.schema(new_latest.schema).parquet(silver_path).select(*S.SILVER_BOOKING_COLUMNS)
    new_latest = written(new_latest, "latest")
    keys = new_latest.select("booking_id")
    span = keys.agg(F.min("booking_id").alias("least"), F.max("booking_id").alias("most")).first()
    near = old.where(F.col("booking_id").between(span["least"], span["most"]))
    old_affected = written(near.join(keys, "booking_id", "left_semi"), "affected")
    merged = dedupe_latest(
        old_affected.unionByName(new_latest), S.BOOKING_KEY, S.BOOKING_ORDER
    ).select(*S.SILVER_BOOKING_COLUMNS)
    dates = written(old_affected.select("booking_date").unionByName(new_latest.select("booking_date")).distinct(), "dates")
    untouched = old.join(dates, "booking_date", "left_semi").join(keys, "booking_id", "left_anti")
    untouched.unionByName(merged).write.mode("overwrite").parquet(rebuilt_path)
    left = spark.read.parquet(rebuilt_path).select("booking_date").distinct()
    dates.join(left, "booking_date", "left_anti").write.mode("overwrite").parquet(emptied_path)


def _write_silver(df: DataFrame, path: str) -> None:
    (
        df.repartitionByRange(slice_count(df), "booking_date", "booking_id").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("booking_date").parquet(path)
    )


def start_incremental_bookings(
    spark: SparkSession,
    landing_dir: str,
    routes_path: str,
    silver_path: str,
    quarantine_path: str,
    checkpoint_dir: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream over ``landing_dir`` (``load_date=D/`` CSV folders)."""
    stream = (
        spark.readStream.schema(text_schema([*BOOKING_COLUMNS, "load_date"]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(landing_dir)
    )
    work_dir = os.path.join(checkpoint_dir, "_work")

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        merge_bookings_batch(batch, epoch_id, routes_path, silver_path, quarantine_path, work_dir)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", os.path.join(checkpoint_dir, "state"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_quarantine(spark: SparkSession, quarantine_path: str) -> DataFrame:
    return spark.read.parquet(quarantine_path).drop("epoch")


__all__ = ["merge_bookings_batch", "start_incremental_bookings", "read_quarantine"]
