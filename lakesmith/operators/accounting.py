"""``account``: every landing row is silver, rejected (with a reason) or a removed duplicate.

Metrics are produced in long form ``(dataset, metric, reason, value)`` from two aggregates: the
classified rows grouped by reason and the silver row count. Both are partial aggregates, so only a
handful of rows ever cross a shuffle, whatever the input size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classify import REASON

METRIC_SCHEMA = "dataset string, metric string, reason string, value bigint"


def _part_counts(classified: DataFrame, silver: DataFrame, reason_column: str) -> DataFrame:
    landing = classified.select(F.lit("landing").alias("part"), F.col(reason_column).alias("reason"))
    kept = silver.select(F.lit("silver").alias("part"), F.lit(None).cast("string").alias("reason"))
    return landing.unionByName(kept).groupBy("part", "reason").agg(F.count(F.lit(1)).alias("n"))


def totals(classified: DataFrame, silver: DataFrame, reason_column: str = REASON) -> DataFrame:
    """One row: landing_rows, silver_rows, rejected, duplicates_removed."""
    counts = _part_counts(classified, silver, reason_column)
    is_landing = F.col("part") == "landing"
    t = counts.agg(
        F.coalesce(F.sum(F.when(is_landing, F.col("n"))), F.lit(0)).alias("landing_rows"),
        F.coalesce(F.sum(F.when(is_landing & F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum(F.when(~is_landing, F.col("n"))), F.lit(0)).alias("silver_rows"),
    )
    return t.select(
        F.col("landing_rows").cast("bigint").alias("landing_rows"),
        F.col("silver_rows").cast("bigint").alias("silver_rows"),
        (F.col("landing_rows") - F.col("accepted")).cast("bigint").alias("rejected"),
        (F.col("accepted") - F.col("silver_rows")).cast("bigint").alias("duplicates_removed"),
    )


def account(dataset: str, classified: DataFrame, silver: DataFrame, reason_column: str = REASON) -> DataFrame:
    """Long-form metrics for one dataset, including the rejected count per reason."""
    summary = totals(classified, silver, reason_column).select(
        F.lit(dataset).alias("dataset"),
        F.expr(
            "stack(4, 'landing_rows', landing_rows, 'silver_rows', silver_rows, "
            "'rejected', rejected, 'duplicates_removed', duplicates_removed) as (metric, value)"
        ),
    )
    summary = summary.select("dataset", "metric", F.lit(None).cast("string").alias("reason"), "value")
    by_reason = (
        classified.where(F.col(reason_column).isNotNull())
        .groupBy(reason_column)
        .agg(F.count(F.lit(1)).alias("value"))
        .select(
            F.lit(dataset).alias("dataset"),
            F.lit("rejected_by_reason").alias("metric"),
            F.col(reason_column).alias("reason"),
            F.col("value").cast("bigint").alias("value"),
        )
    )
    return summary.unionByName(by_reason)


def landing_counts(reasons: Sequence[str], reason_column: str = REASON) -> list[Column]:
    """Aggregates over classified rows for a write to observe: all rows, and those of each declared reason."""
    reason = F.col(reason_column)
    return [F.count(F.lit(1)).alias("landing_rows"), *[F.count_if(reason == r).alias(f"rejected: {r}") for r in reasons]]


def silver_counts() -> list[Column]:
    """The aggregate over silver rows for their write to observe."""
    return [F.count(F.lit(1)).alias("silver_rows")]


def observed_metrics(dataset: str, observed: Mapping[str, int], reasons: Sequence[str]) -> list[tuple]:
    """The rows of :func:`account` from what the writes of the classified and of the silver rows have observed.

    ``observed`` holds the values of :func:`landing_counts` and :func:`silver_counts`. A reason without rows has no row.
    """
    by_reason = {r: observed[f"rejected: {r}"] for r in reasons}
    rejected = sum(by_reason.values())
    fixed = {
        "landing_rows": observed["landing_rows"],
        "silver_rows": observed["silver_rows"],
        "rejected": rejected,
        "duplicates_removed": observed["landing_rows"] - rejected - observed["silver_rows"],
    }
    rows = [(dataset, metric, None, value) for metric, value in fixed.items()]
    return rows + [(dataset, "rejected_by_reason", r, n) for r, n in by_reason.items() if n]


def row_count_metric(dataset: str, metric: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(
        F.lit(dataset).alias("dataset"), F.lit(metric).alias("metric"),
        F.lit(None).cast("string").alias("reason"), "value",
    )


def identity(dataset: str, classified: DataFrame, silver: DataFrame, reason_column: str = REASON) -> DataFrame:
    """Conservation check: landing = silver + rejected + duplicates removed."""
    t = totals(classified, silver, reason_column)
    return t.select(
        F.lit(dataset).alias("dataset"),
        "*",
        (F.col("landing_rows") == F.col("silver_rows") + F.col("rejected") + F.col("duplicates_removed")).alias(
            "balanced"
        ),
    )


def account_by_key(dataset: str, classified: DataFrame, key, reason_column: str = REASON) -> DataFrame:
    """Same long-form metrics as :func:`account` in ONE pass over the classified rows, without
    running the de-duplication: silver keeps exactly one row per distinct key of the accepted
    rows, so ``silver_rows`` is the accepted group's distinct-key count.

    Plan: partial aggregate on (reason, key) -> shuffle -> tiny aggregate on reason. A key with a
    huge number of copies collapses map-side before anything is shuffled.
    """
    per_key = classified.groupBy(F.col(reason_column).alias("reason"), *key).agg(F.count(F.lit(1)).alias("n"))
    per_reason = per_key.groupBy("reason").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"))
    accepted_ = F.col("reason").isNull()
    t = per_reason.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("landing_rows"),
        F.coalesce(F.sum(F.when(accepted_, F.col("rows"))), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum(F.when(accepted_, F.col("keys"))), F.lit(0)).alias("silver_rows"),
        # one entry per declared reason
        F.collect_list(F.when(~accepted_, _metric("rejected_by_reason", "rows", "reason"))).alias("by_reason"),
    )
    fixed = F.array(
        _metric("landing_rows", "landing_rows"),
        _metric("silver_rows", "silver_rows"),
        _metric("rejected", F.col("landing_rows") - F.col("accepted")),
        _metric("duplicates_removed", F.col("accepted") - F.col("silver_rows")),
    )
    return t.select(F.explode(F.concat(fixed, "by_reason")).alias("m")).select(
        F.lit(dataset).alias("dataset"), "m.metric", "m.reason", "m.value"
    )


def identity_by_key(dataset: str, classified: DataFrame, key, reason_column: str = REASON) -> DataFrame:
    """The row of :func:`identity` from the one pass of :func:`account_by_key`."""
    metrics = account_by_key(dataset, classified, key, reason_column)
    names = ("landing_rows", "silver_rows", "rejected", "duplicates_removed")
    t = metrics.groupBy("dataset").agg(*[F.sum(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])
    balanced = F.col("landing_rows") == F.col("silver_rows") + F.col("rejected") + F.col("duplicates_removed")
    return t.withColumn("balanced", balanced)


def _metric(name: str, value, reason: str | None = None):
    value = F.col(value) if isinstance(value, str) else value
    why = F.lit(None) if reason is None else F.col(reason)
    return F.struct(F.lit(name).alias("metric"), why.cast("string").alias("reason"), value.cast("bigint").alias("value"))
