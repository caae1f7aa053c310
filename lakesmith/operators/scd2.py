"""Type-2 slowly changing dimension from a version history.

Given one row per (key, version time) with tracked attributes, the operator

1. numbers the versions of each key and compares every row's attributes with the previous row's
   (``lag`` of one struct; ``<=>`` on structs is NULL-safe field by field),
2. keeps the first row and every row whose attributes changed (re-sent identical records collapse;
   A -> B -> A gives three versions),
3. closes each kept version with the next kept version's time (half-open ``[from, to)``); the first
   window starts at an open-start sentinel and the last ends at an open-end sentinel.

All windows share one partitioning (the key) and one ordering, so the plan has a single shuffle and
a single sort. Rows per key are bounded by the number of distinct version times of that key (for a
date-typed version column: days), because the history is de-duplicated on (key, version time)
before it gets here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import iso_date_text, surrogate_key

# Open window sentinels.
OPEN_START = dt.date(1900, 1, 1)
OPEN_END = dt.date(9999, 12, 31)


def _w(key: Sequence[str], version: str):
    return Window.partitionBy(*key).orderBy(F.col(version).asc_nulls_last())


def change_detection(history: DataFrame, key: Sequence[str], tracked: Sequence[str], version: str) -> DataFrame:
    """History rows plus ``version_no``, ``first_seen`` and ``is_change`` (first row or changed)."""
    w = _w(key, version)
    attrs = F.struct(*[F.col(c) for c in tracked])
    ordered = history.select(
        "*",
        F.row_number().over(w).cast("bigint").alias("version_no"),
        F.lag(attrs).over(w).alias("__prev"),
        F.min(version).over(Window.partitionBy(*key)).alias("first_seen"),
    )
    return ordered.withColumn(
        "is_change", (F.col("version_no") == 1) | ~attrs.eqNullSafe(F.col("__prev"))
    ).drop("__prev")


def scd2(
    history: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    version: str,
    surrogate: str = "surrogate_key",
    first_seen: str = "first_seen_date",
    open_start=OPEN_START,
    open_end=OPEN_END,
) -> DataFrame:
    """Versions with ``surrogate, *key, *tracked, first_seen, valid_from, valid_to, is_current``."""
    changes = change_detection(history, key, tracked, version).where("is_change")
    w = _w(key, version)
    start = F.lit(open_start)
    if isinstance(open_start, dt.datetime):
        start = start.cast("timestamp_ntz")
    end = F.lit(open_end)
    if isinstance(open_end, dt.datetime):
        end = end.cast("timestamp_ntz")
    windows = changes.select(
        *key,
        *tracked,
        F.col("first_seen").alias(first_seen),
        F.when(F.col("version_no") == 1, start).otherwise(F.col(version)).alias("valid_from"),
        F.lead(version).over(w).alias("__next"),
    )
    from_text = iso_date_text("valid_from") if not isinstance(open_start, dt.datetime) else F.col("valid_from").cast("string")
    return windows.select(
        surrogate_key(*[F.col(k).cast("string") for k in key], from_text).alias(surrogate),
        *key,
        *tracked,
        first_seen,
        "valid_from",
        F.coalesce(F.col("__next"), end).alias("valid_to"),
        F.col("__next").isNull().alias("is_current"),
    )


# ---------------------------------------------------------------------------------------------
# Skew-safe variant for histories whose per-key row count is NOT bounded (e.g. timestamp grain).
#
# The window variant above keeps every row of a key in one task. Here the history is range-
# partitioned on (key, version) -- a key with a third of all rows spans many tasks -- and sorted
# within partitions; every row gets ``monotonically_increasing_id`` (partition index in the upper
# bits, consecutive row numbers within a partition), and the result is written once so the ids are
# fixed. A row's predecessor is ``id - 1`` inside its partition, or the last id of the previous
# non-empty partition (a boundary table with one row per partition: a size bound known from the
# partition count). "Previous row" and "next version" then become equi-joins on unique ids, which
# cannot skew.
def _ordered_ids(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    from ..session import materialize
    from ..sources.files import slice_count

    ranged = df.repartitionByRange(slice_count(df), *order).sortWithinPartitions(*order)
    tagged = ranged.select("*", F.monotonically_increasing_id().alias("__id"), F.spark_partition_id().alias("__part"))
    t = materialize(tagged, name)
    bounds = t.groupBy("__part").agg(F.min("__id").alias("__lo"), F.max("__id").alias("__hi"))
    by_part = Window.orderBy("__part")  # one row per partition: bounded by the partition count
    bounds = bounds.select(
        "__part", "__lo", "__hi",
        F.lag("__hi").over(by_part).alias("__prev_hi"), F.lead("__lo").over(by_part).alias("__next_lo"),
    )
    t = t.join(F.broadcast(bounds), "__part")
    helpers = {"__part", "__id", "__lo", "__hi", "__prev_hi", "__next_lo"}
    return t.select(
        *[c for c in t.columns if c not in helpers],
        "__id",
        F.when(F.col("__id") == F.col("__lo"), F.col("__prev_hi")).otherwise(F.col("__id") - 1).alias("__prev_id"),
        F.when(F.col("__id") == F.col("__hi"), F.col("__next_lo")).otherwise(F.col("__id") + 1).alias("__next_id"),
    )


def scd2_ranged(
    history: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    version: str,
    surrogate: str = "surrogate_key",
    first_seen: str = "first_seen_date",
    open_start=OPEN_START,
    open_end=OPEN_END,
    version_text=None,
) -> DataFrame:
    """Same contract as :func:`scd2` (one row per (key, version) expected), skew-safe for keys with
    unbounded histories. ``version_text`` renders ``valid_from`` for the surrogate key."""
    start = F.lit(open_start)
    end = F.lit(open_end)
    if isinstance(open_start, dt.datetime):
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    render = version_text or (lambda c: c.cast("string"))
    keys = F.struct(*[F.col(k) for k in key])
    attrs = F.struct(*[F.col(c) for c in tracked])

    t = _ordered_ids(history.select(*key, *tracked, version), [*key, version], "scd2-rows")
    prev = t.select(F.col("__id").alias("__p_id"), keys.alias("__p_key"), attrs.alias("__p_attrs"))
    j = t.join(prev, t["__prev_id"] == prev["__p_id"], "left")
    is_first = ~keys.eqNullSafe(F.col("__p_key"))
    changes = j.where(is_first | ~attrs.eqNullSafe(F.col("__p_attrs"))).select(
        *key, *tracked, version, is_first.alias("__first")
    )
    # first appearance per key: a partial aggregate (hot keys collapse map-side), joined back
    seen = history.groupBy(*key).agg(F.min(version).alias(first_seen))
    changes = changes.join(seen, list(key))

    c = _ordered_ids(changes, [*key, version], "scd2-changes")
    nxt = c.select(F.col("__id").alias("__n_id"), keys.alias("__n_key"), F.col(version).alias("__n_version"))
    w = c.join(nxt, c["__next_id"] == nxt["__n_id"], "left")
    next_change = F.when(keys.eqNullSafe(F.col("__n_key")), F.col("__n_version"))
    valid_from = F.when(F.col("__first"), start).otherwise(F.col(version))
    out = w.select(*key, *tracked, first_seen, valid_from.alias("valid_from"), next_change.alias("__next"))
    return out.select(
        surrogate_key(*[F.col(k).cast("string") for k in key], render(F.col("valid_from"))).alias(surrogate),
        *key,
        *tracked,
        first_seen,
        "valid_from",
        F.coalesce(F.col("__next"), end).alias("valid_to"),
        F.col("__next").isNull().alias("is_current"),
    )
