"""Incremental SCD2: a late load merged into a stored dimension, and what that means for facts and marts.

A load touches few keys. Their versions are rebuilt from their whole history, since a row may be dated before rows that came
earlier, and replace the stored ones; all other keys' versions are left as they are. The difference is kept as *segments*: for each
touched key the times at which another version than before is in force, with both versions. They follow from a sweep over the starts
of the old and the new windows, so no pair of versions is made. Facts of other keys, or outside the segments, cannot change:

* ``reresolved`` finds the facts within segments whose surrogate key is another now;
* ``signed`` turns them into rows that take a fact out of its old group (-1) and put it into its new one (+1), for measures that
  are kept as sums of such rows, and for distinct counts kept as counts per (group, member), which can go down.

Windows are half-open, contiguous per key and bounded by the number of distinct version times of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pit import point_in_time_join
from .scd2 import OPEN_END, scd2


def merged_versions(
    history: DataFrame, stored: DataFrame, touched: DataFrame, key: str, tracked: Sequence[str], version: str, surrogate: str, first_seen: str,
    staged: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """(the touched keys' versions now, the segments). ``history`` and ``stored`` may be limited to slices that hold all touched keys.

    ``staged`` writes the versions, which both results are made of, and reads them back."""
    now = staged(scd2(history.join(touched, key, "left_semi"), [key], list(tracked), version, surrogate, first_seen))
    before = stored.join(touched, key, "left_semi")
    return now, segments(before, now, key, [surrogate, *tracked])


def segments(before: DataFrame, now: DataFrame, key: str, columns: Sequence[str], open_end=OPEN_END) -> DataFrame:
    """``key``, ``seg_from``, ``seg_to``, ``old`` and ``new`` (structs of ``columns``; ``old`` is NULL for a new key) where these differ."""
    held = F.struct(*[F.col(c) for c in columns])
    starts = before.select(key, F.col("valid_from").alias("seg_from"), held.alias("old")).unionByName(
        now.select(key, F.col("valid_from").alias("seg_from"), held.alias("new")), allowMissingColumns=True
    )
    at = starts.groupBy(key, "seg_from").agg(F.max("old").alias("old"), F.max("new").alias("new"))
    w = Window.partitionBy(key).orderBy("seg_from")
    carried = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = at.select(
        key, "seg_from", F.coalesce(F.lead("seg_from").over(w), F.lit(open_end)).alias("seg_to"),
        F.last("old", ignorenulls=True).over(carried).alias("old"), F.last("new", ignorenulls=True).over(carried).alias("new"),
    )
    return swept.where(~F.col("old").eqNullSafe(F.col("new")))


def narrowed(changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Segments whose ``old`` and ``new`` have only these columns; those where none of them differs stay."""
    cut = lambda c: F.when(F.col(c).isNotNull(), F.struct(*[F.col(f"{c}.{x}").alias(x) for x in columns])).alias(c)
    return changes.select(key, "seg_from", "seg_to", cut("old"), cut("new"))


def reresolved(facts: DataFrame, changes: DataFrame, key: str, time: str) -> DataFrame:
    """``facts`` (with ``key`` and ``time``) that lie in a segment, with its ``old`` and ``new``."""
    other = changes.withColumnRenamed(key, "__seg_key")
    return point_in_time_join(facts, other, key, time, "__seg_key", "seg_from", "seg_to", how="inner").drop("__seg_key", "seg_from", "seg_to")


def signed(moved: DataFrame, old_group: Sequence[Column], new_group: Sequence[Column], measures: Sequence[Column]) -> DataFrame:
    """For every moved fact a row of its old group with sign -1 and of its new group with +1; ``measures`` are multiplied by it.

    The columns are named as their aliases; a fact that stays in its group gives nothing."""
    arms = F.array(F.struct(F.lit(-1).alias("sign"), *old_group), F.struct(F.lit(1).alias("sign"), *new_group))
    rows = moved.withColumn("__arms", arms).select(*measures, F.explode("__arms").alias("__arm"))
    names = [c for c in rows.columns if c != "__arm"]
    return rows.select("__arm.*", *[(F.col(n) * F.col("__arm.sign")).alias(n) for n in names]).drop("sign")


def summed(state: DataFrame | None, delta: DataFrame, group: Sequence[str]) -> DataFrame:
    """State rows (``group`` and sums) after a delta; groups whose sums are all zero are gone."""
    rows = delta if state is None else state.unionByName(delta)
    sums = [c for c in rows.columns if c not in group]
    kinds = dict(rows.dtypes)
    out = rows.groupBy(*group).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in sums])
    zero = F.lit(True)
    for c in sums:
        zero = zero & (F.col(c) == 0)
    return out.where(~zero)
