"""Table parity: the multiset symmetric difference of two tables with the same columns.

Equivalent to ``left.exceptAll(right)`` and ``right.exceptAll(left)``, computed in ONE aggregation:
both sides are tagged, grouped by every column, and each distinct row contributes
``max(n_left - n_right, 0)`` and ``max(n_right - n_left, 0)``. A row repeated millions of times is
collapsed by the partial aggregate before the shuffle.

``bucketed_difference`` gives the same row for tables that should be equal, or nearly so: buckets of row hashes are
compared by order-free sums, and only rows of the buckets that differ are grouped and shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Buckets that row hashes are summed in. The table of sums has a row each, and those that differ are broadcast.
BUCKETS = 65_536


def symmetric_difference(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """One row: ``table_name, left_rows, right_rows, only_left, only_right``."""
    cols = left.columns
    tagged = left.select(*cols, F.lit(1).alias("__side")).unionByName(right.select(*cols, F.lit(2).alias("__side")))
    per_row = tagged.groupBy(*cols).agg(
        F.count_if(F.col("__side") == 1).alias("l"), F.count_if(F.col("__side") == 2).alias("r")
    )
    out = per_row.agg(
        F.sum("l").alias("left_rows"),
        F.sum("r").alias("right_rows"),
        F.sum(F.greatest(F.col("l") - F.col("r"), F.lit(0))).alias("only_left"),
        F.sum(F.greatest(F.col("r") - F.col("l"), F.lit(0))).alias("only_right"),
    )
    return out.select(
        F.lit(name).alias("table_name"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("left_rows", "right_rows", "only_left", "only_right")],
    )


def _hashed(df: DataFrame, columns: list[str], side: int, buckets: int) -> DataFrame:
    # a hash passes over NULLs, so each column is led by whether it is one
    marked = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    rows = df.select(*columns, F.xxhash64(*marked).alias("__h1"), F.xxhash64(F.lit(1), *marked).alias("__h2"))
    return rows.withColumns({"__side": F.lit(side), "__bucket": F.pmod("__h1", F.lit(buckets))})


def bucket_sums(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, l, r, same``: rows of each side by bucket of the row hash, and whether the bucket's sums are equal.

    Partial aggregates: a map task ships at most one row a bucket. The sums are of the 32-bit halves of two 64-bit
    hashes, so they do not overflow below 2^31 rows a bucket; buckets of other rows have equal sums with a chance
    of about 2^-128.
    """
    rows = _hashed(left, left.columns, 1, buckets).unionByName(_hashed(right, left.columns, -1, buckets))
    halves = [h for c in ("__h1", "__h2") for h in (F.col(c).bitwiseAND(0xFFFFFFFF), F.shiftright(c, 32))]
    sums = rows.groupBy(F.col("__bucket").alias("bucket")).agg(
        F.count_if(F.col("__side") == 1).alias("l"),
        F.count_if(F.col("__side") == -1).alias("r"),
        *[F.sum(h * F.col("__side")).alias(f"s{i}") for i, h in enumerate(halves)],
    )
    same = reduce(lambda a, b: a & b, [F.col("l") == F.col("r"), *[F.col(f"s{i}") == 0 for i in range(len(halves))]])
    return sums.select("bucket", "l", "r", same.alias("same"))


def bucketed_difference(left: DataFrame, right: DataFrame, name: str, buckets: int = BUCKETS) -> DataFrame:
    """The row of ``symmetric_difference``, where only rows of differing buckets go through its aggregation."""
    sums = materialize(bucket_sums(left, right, buckets), "bucket-sums")
    differ = F.broadcast(sums.where("NOT same").select(F.col("bucket").alias("__bucket")))  # at most ``buckets`` rows
    parts = [_hashed(df, left.columns, 0, buckets).join(differ, "__bucket", "left_semi").select(*left.columns) for df in (left, right)]
    equal = sums.where("same").agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    equal = equal.select(F.lit(name).alias("table_name"), "left_rows", "right_rows", F.lit(0).alias("only_left"), F.lit(0).alias("only_right"))
    both = symmetric_difference(*parts, name).unionByName(equal)
    totals = both.groupBy("table_name").agg(*[F.sum(c).alias(c) for c in both.columns[1:]])
    return totals.select("table_name", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in both.columns[1:]])
