"""Point-in-time joins.

``point_in_time_join``: equality on the natural key plus a half-open validity range
``valid_from <= t < valid_to``. Catalyst plans it as a hash / sort-merge join on the key with the
range as a residual predicate; with non-overlapping windows each fact row matches at most one
version. A key holding a large share of the facts is salted by the fact time: each version is
repeated once per salt, so such a key spans several partitions from the start. The salted version
side has its own exchange, whatever produced it (SCD2 windows leave the key's partitioning behind,
which AQE's skew rule does not look through), so AQE splits what is still too large.

``asof_lookup``: for every (key, t) of the left side, the attributes of the latest right-side row
with ``right_time <= t`` -- without emitting (left, right) pairs. The distinct (key, t) probes are
unioned with the history, one window per key carries the latest history struct forward, and the
result is equi-joined back. Probes are de-duplicated first (a partial aggregate), so a key with a
huge number of left rows still contributes at most one probe per distinct time.

``interval_merge_join``: the point-in-time join for histories without a bound on a key's versions. Facts and
windows are sorted together by (key, time) and swept forward once; no pair of a fact and a version
is made but the one that matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALT = "__pit_salt"


def point_in_time_join(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    fact_time: str,
    version_key: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "left",
    salts: int = 4,
) -> DataFrame:
    salted = versions.withColumn(SALT, F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    cond = (
        (facts[fact_key] == salted[version_key])
        & (F.pmod(F.xxhash64(facts[fact_time]), F.lit(salts)).cast("int") == salted[SALT])
        & (facts[fact_time] >= salted[valid_from])
        & (facts[fact_time] < salted[valid_to])
    )
    return facts.join(salted, cond, how).drop(SALT)


def interval_merge_join(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    fact_time: str,
    version_key: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """``point_in_time_join`` (left) by one forward sweep; the windows of a key must not overlap.

    Facts and window starts are range-partitioned together on (key, time), ties broken by a hash of the row, so a
    key with any number of versions and facts spans as many slices as it needs. Within a slice the last window opened is
    carried forward; the window that is open where a slice begins comes from a boundary table of one row a slice. A
    fact takes that window if it is not closed yet. Empty windows match nothing; facts without key or time keep NULLs.
    """
    from ..session import materialize
    from ..sources.files import slice_count

    fact_row = F.struct(*[F.col(c) for c in facts.columns])
    version_row = F.struct(*[F.col(c) for c in versions.columns])
    rows = facts.select(
        F.col(fact_key).alias("__k"), F.col(fact_time).alias("__t"), F.lit(1).alias("__side"),
        F.xxhash64(*facts.columns).alias("__tie"), fact_row.alias("__fact"),
    )
    opened = versions.where(F.col(valid_from) < F.col(valid_to)).where(F.col(version_key).isNotNull()).select(
        F.col(version_key).alias("__k"), F.col(valid_from).alias("__t"), F.lit(0).alias("__side"),
        F.lit(0).cast("bigint").alias("__tie"), version_row.alias("__open"),
    )
    both = opened.unionByName(rows, allowMissingColumns=True)
    order = ["__k", "__t", "__side", "__tie"]
    ranged = both.repartitionByRange(slice_count(facts, versions), *order)
    swept = materialize(ranged.withColumn("__part", F.spark_partition_id()), "interval-merge")

    start = F.when(F.col("__side") == 0, F.struct("__k", "__t"))
    last = swept.groupBy("__part").agg(F.max_by(F.when(F.col("__side") == 0, F.struct("__k", "__open")), start).alias("__last"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    carry = last.select("__part", F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    forward = Window.partitionBy("__part", "__k").orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        swept.withColumn("__here", F.last("__open", ignorenulls=True).over(forward))
        .where(F.col("__side") == 1)
        .join(F.broadcast(carry), "__part", "left")
        .withColumn("__v", F.coalesce("__here", F.when(F.col("__k") == F.col("__carry.__k"), F.col("__carry.__open"))))
    )
    in_force = F.when(F.col("__t") < F.col(f"__v.{valid_to}"), F.col("__v"))
    found = found.select("__fact", in_force.alias("__v"))
    return found.select(*[F.col(f"__fact.{c}").alias(c) for c in facts.columns], *[F.col(f"__v.{c}").alias(c) for c in versions.columns])


def asof_lookup(
    probes: DataFrame,
    history: DataFrame,
    key: Sequence[str],
    probe_time: str,
    history_time: str,
    values: Sequence[str],
    prefix: str = "asof_",
) -> DataFrame:
    """``probes`` plus ``prefix+value`` columns: history values in force at ``probe_time``.

    "In force" means the history row with the greatest ``history_time <= probe_time`` (NULL when
    none exists). Probe rows keep their multiplicity; equal times resolve to the history row.
    """
    distinct_probes = probes.select(*key, F.col(probe_time).alias("__t")).distinct()
    lookups = distinct_probes.select(
        *key, "__t", F.lit(1).alias("__side"), F.lit(None).alias("__val")
    )
    hist = history.where(F.col(history_time).isNotNull()).select(
        *key,
        F.col(history_time).alias("__t"),
        F.lit(0).alias("__side"),
        F.struct(*[F.col(v) for v in values]).alias("__val"),
    )
    events = hist.unionByName(lookups.withColumn("__val", F.lit(None).cast(hist.schema["__val"].dataType)))
    w = (
        Window.partitionBy(*key)
        .orderBy(F.col("__t").asc_nulls_first(), F.col("__side"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    resolved = (
        events.withColumn("__in_force", F.last("__val", ignorenulls=True).over(w))
        .where(F.col("__side") == 1)
        .select(*key, F.col("__t"), *[F.col(f"__in_force.{v}").alias(prefix + v) for v in values])
    )
    return probes.join(
        resolved,
        [probes[k] == resolved[k] for k in key] + [probes[probe_time] == resolved["__t"]],
        "left",
    ).drop(*[resolved[k] for k in key]).drop("__t")


def asof_lookup_ranged(
    probes: DataFrame,
    history: DataFrame,
    key: Sequence[str],
    probe_time: str,
    history_time: str,
    values: Sequence[str],
    prefix: str = "asof_",
) -> DataFrame:
    """:func:`asof_lookup` for histories without a per-key bound (e.g. timestamp grain).

    Probes and history are range-partitioned together on (key, time, side), so a hot key spans
    many tasks; the carry-forward window is partitioned by (range partition, key) and therefore
    never holds more than one partition. The value in force when a key's rows start in a later
    partition is the last history row of the earlier partitions (one boundary row per partition,
    a size bound known from the partition count), used when it belongs to the same key.
    """
    from ..session import materialize
    from ..sources.files import slice_count

    distinct_probes = probes.select(*key, F.col(probe_time).alias("__t")).distinct()
    hist = history.where(F.col(history_time).isNotNull()).select(
        *key, F.col(history_time).alias("__t"), F.lit(0).alias("__side"),
        F.struct(*[F.col(v) for v in values]).alias("__val"),
    )
    lookups = distinct_probes.select(
        *key, "__t", F.lit(1).alias("__side"), F.lit(None).cast(hist.schema["__val"].dataType).alias("__val")
    )
    order = [*key, "__t", "__side"]
    ranged = hist.unionByName(lookups).repartitionByRange(slice_count(probes, history), *order)
    events = materialize(ranged.withColumn("__part", F.spark_partition_id()), "asof-events")

    keys = F.struct(*[F.col(k) for k in key])
    local = Window.partitionBy("__part", *key).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    by_time = F.struct(*[F.col(c) for c in order])
    # of every partition, also those of probes alone: they pass on what came before them
    last_hist = events.groupBy("__part").agg(
        F.max_by(
            F.when(F.col("__side") == 0, F.struct(keys.alias("k"), F.col("__val").alias("v"))),
            F.when(F.col("__side") == 0, by_time),
        ).alias("__last")
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    carry = last_hist.select("__part", F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    resolved = (
        events.withColumn("__local", F.last("__val", ignorenulls=True).over(local))
        .where(F.col("__side") == 1)
        .join(F.broadcast(carry), "__part", "left")
        .select(
            *key, "__t",
            F.coalesce(
                F.col("__local"), F.when(keys.eqNullSafe(F.col("__carry.k")), F.col("__carry.v"))
            ).alias("__in_force"),
        )
    )
    resolved = resolved.select(*key, "__t", *[F.col(f"__in_force.{v}").alias(prefix + v) for v in values])
    return probes.join(
        resolved,
        [probes[k] == resolved[k] for k in key] + [probes[probe_time] == resolved["__t"]],
        "left",
    ).drop(*[resolved[k] for k in key]).drop("__t")
