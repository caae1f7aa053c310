"""Row numbers of a table of any size, and slice counts that grow with the bytes read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Bytes of input for a slice of a range partitioning or a bucket.
SLICE_BYTES = 128 << 20
#: Rows of a partition are numbered in the low bits of ``monotonically_increasing_id``.
LOW = (1 << 33) - 1


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` scans (0 for rows that come from the driver)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    found = (leaves.apply(i) for i in range(leaves.size()))
    return sum(int(str(leaf.stats().sizeInBytes())) for leaf in found if leaf.getClass().getSimpleName() == "LogicalRelation")


def slice_count(df: DataFrame, share: float = 1.0) -> int:
    """Slices for a shuffle of ``share`` of the bytes ``df`` scans; at least ``spark.sql.shuffle.partitions``."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(input_bytes(df) * share) // SLICE_BYTES))


def dealt(df: DataFrame, order: Sequence[Column], slices: int, name: str) -> DataFrame:
    """``df`` range partitioned and sorted by ``order``, written with each row's ``part`` and its number ``at`` in that."""
    row = F.monotonically_increasing_id()
    rows = df.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    return staged(rows.select("*", row.alias("at")).select("*", F.shiftright("at", 33).alias("part")).withColumn("at", F.col("at").bitwiseAND(LOW)), name)


def numbered(df: DataFrame, order: Sequence[Column], slices: int, name: str) -> DataFrame:
    """``df`` with ``pos``, its rows' number from 0 in ``order``: no task sees over one slice of the rows.

    The window runs over one row a slice. Rows that are equal in ``order`` are numbered in any order.
    """
    rows = dealt(df, order, slices, name)
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(sizes.select("part", before.alias("before")), "part").withColumn("pos", F.col("before") + F.col("at")).drop("part", "at", "before")
