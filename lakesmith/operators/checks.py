"""Data-quality checks: each returns ONE row ``(check_name, target, violations)``.

A check that returns offending rows proves little when it returns none, so every check reports
its violation count instead (0 on good data). Counting semantics follow the usual declarative
tests: ``unique`` counts duplicated values, ``not_null`` NULL rows, ``accepted_values`` distinct
unexpected (non-NULL) values, ``relationships`` child rows without a parent, ``value_in_range``
rows outside ``[min, max]`` (NULL passes).

Every check is an aggregate (partial aggregation before any shuffle) or an anti-join; none
collects rows. ``gate`` reads the (bounded: one row per check) summary on the driver and refuses to
publish when any check failed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHECK_COLUMNS = ("check_name", "target", "violations")


def _row(check: str, target: str, counted: DataFrame, n: Column) -> DataFrame:
    return counted.agg(n.cast("bigint").alias("violations")).select(
        F.lit(check).alias("check_name"), F.lit(target).alias("target"), F.coalesce("violations", F.lit(0)).alias("violations")
    )


def _count_rows(check: str, target: str, offending: DataFrame) -> DataFrame:
    return _row(check, target, offending, F.count(F.lit(1)))


def unique(df: DataFrame, column: str, target: str) -> DataFrame:
    dup = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _count_rows("unique", target, dup)


def not_null(df: DataFrame, column: str, target: str) -> DataFrame:
    return _row("not_null", target, df, F.count_if(F.col(column).isNull()))


def accepted_values(df: DataFrame, column: str, values: Sequence[str], target: str) -> DataFrame:
    bad = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).select(column).distinct()
    return _count_rows("accepted_values", target, bad)


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str, target: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias("__parent_key"))
    orphans = child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__parent_key"), "left_anti")
    return _count_rows("relationships", target, orphans)


def value_in_range(df: DataFrame, column: str, lo, hi, target: str) -> DataFrame:
    c = F.col(column)
    return _row("value_in_range", target, df, F.count_if((c < lo) | (c > hi)))


def failing_rows(check: str, target: str, offending: DataFrame) -> DataFrame:
    """Generic singular check: the number of rows of an offending-row query."""
    return _count_rows(check, target, offending)


def overlapping_windows(
    versions: DataFrame, key: Sequence[str], valid_from: str, valid_to: str, tiebreak: str, target: str
) -> DataFrame:
    """Number of overlapping version pairs per key, counted with one sweep (no self-join).

    Each proper window contributes a +1 event at ``valid_from`` and a -1 event at ``valid_to``;
    ends sort before starts at the same instant (half-open windows). The number of windows open
    just before a start event is the number of earlier windows it overlaps, so the sum over all
    start events is the number of overlapping pairs.
    """
    proper = versions.where(F.col(valid_from) < F.col(valid_to))
    starts = proper.select(*key, F.col(valid_from).alias("__t"), F.lit(1).alias("__d"), F.col(tiebreak).alias("__tb"))
    ends = proper.select(*key, F.col(valid_to).alias("__t"), F.lit(-1).alias("__d"), F.col(tiebreak).alias("__tb"))
    w = (
        Window.partitionBy(*key)
        .orderBy("__t", "__d", "__tb")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sweep = starts.unionByName(ends).withColumn("__open", F.coalesce(F.sum("__d").over(w), F.lit(0)))
    return _row("no_overlapping_windows", target, sweep, F.sum(F.when(F.col("__d") == 1, F.col("__open"))))


def empty_windows(versions: DataFrame, valid_from: str, valid_to: str, target: str) -> DataFrame:
    return _row("proper_windows", target, versions, F.count_if(~(F.col(valid_from) < F.col(valid_to))))


def union_checks(checks: Iterable[DataFrame]) -> DataFrame:
    checks = list(checks)
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


class QualityGateError(RuntimeError):
    pass


def gate(summary: DataFrame) -> list[tuple[str, str, int]]:
    """Raise when any check has violations; returns the failing checks otherwise empty list.

    ``summary`` has one row per check (a few dozen rows), so reading it on the driver is bounded.
    """
    failed = [
        (r["check_name"], r["target"], int(r["violations"]))
        for r in summary.where(F.col("violations") > 0).collect()
    ]
    if failed:
        raise QualityGateError(f"{len(failed)} data-quality checks failed: {failed}")
    return failed
