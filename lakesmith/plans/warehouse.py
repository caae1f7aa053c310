"""The publish job: landing -> silver/quarantine/metrics -> star schema -> checks -> gate -> publish.

Every layer is written once and read back by the next one, which cuts the lineage at each layer
boundary (a lost executor recomputes at most one layer) and means no DataFrame is evaluated twice:

* the classified rows of each dataset are staged once; silver and quarantine read
  the staged table instead of re-running cleanse + classify. That costs one columnar
  write, but saves two more parses of the raw CSV and two more passes of the regex guards. The
  quarantine read of the staged table is cheap, as it keeps only rejected rows;
* the metrics need no pass of their own: the writes of the classified and of the silver rows
  observe their counts, above every shuffle, so a task that is run again is counted once;
* silver bookings are Hive-partitioned by ``booking_date``; rows are range-partitioned on
  (booking_date, booking_id) first, so tasks write few files and a hot date is split over tasks;
* silver and star are written to a run directory and checked there. Only when the quality gate
  passes, one row naming the run is appended to the pointer table; nothing live is ever deleted
  or overwritten, so a failed gate or a crash leaves the earlier run readable as it was.

All paths live below a root the caller passes in (on a cluster: a shared folder). ``build_silver``
overwrites its folder, so a rebuild over the same inputs is idempotent.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.accounting import METRIC_SCHEMA, landing_counts, observed_metrics, silver_counts
from ..operators.checks import gate
from ..operators.classify import classify, quarantine
from ..sources.files import read_parquet, write_parquet
from ..sources.landing import BOOKING_COLUMNS, PASSENGER_COLUMNS
from . import quality as Q
from . import silver as S
from . import star as T


def _p(root: str, *parts: str) -> str:
    return os.path.join(root, *parts)


@dataclass(frozen=True)
class SilverPaths:
    root: str

    @property
    def routes(self) -> str:
        return _p(self.root, "silver", "routes")

    @property
    def bookings(self) -> str:
        return _p(self.root, "silver", "bookings")

    @property
    def passengers(self) -> str:
        return _p(self.root, "silver", "passengers")

    @property
    def quarantine_bookings(self) -> str:
        return _p(self.root, "quarantine", "bookings")

    @property
    def quarantine_passengers(self) -> str:
        return _p(self.root, "quarantine", "passengers")

    @property
    def metrics(self) -> str:
        return _p(self.root, "metrics")

    def staged(self, name: str) -> str:
        return _p(self.root, "_staging", name)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """Metrics sink: one JSON document per metric row, sorted by key.

    The metrics frame has one row per (dataset, metric, reason) -- a few dozen rows whatever the
    data size -- so writing it as a single sorted file is bounded.
    """
    metrics.orderBy("dataset", "metric", F.col("reason").asc_nulls_first()).coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).json(path)


def build_silver(spark: SparkSession, inputs: S.SilverInputs, root: str):
    """Write silver, quarantine and metrics for all datasets below ``root`` (overwrite).

    Returns the paths and the opened silver tables (bookings, passengers, routes)."""
    paths = SilverPaths(root)

    seen_r = write_parquet(S.silver_routes(inputs), paths.routes, metrics=silver_counts())
    routes = read_parquet(spark, paths.routes)

    # bookings: classify once (membership against the written routes), stage, fan out
    cleansed_b = S.cleanse_bookings(inputs)
    rules_b = S.with_record_rule(cleansed_b, S.booking_rules(routes))
    reasons_b = list(dict.fromkeys(r.reason for r in rules_b))
    staged_b = paths.staged("classified_bookings")
    seen_b = write_parquet(classify(cleansed_b, rules_b), staged_b, metrics=landing_counts(reasons_b))
    cb = read_parquet(spark, staged_b)
    latest_b = S.dedupe_bookings(cb)
    seen_b |= write_parquet(
        latest_b, paths.bookings, partition_columns=["booking_date"], cluster_by=["booking_id"], metrics=silver_counts()
    )
    write_parquet(quarantine(cb, BOOKING_COLUMNS, keep=S.kept_columns(cb)), paths.quarantine_bookings)

    cleansed_p = S.cleanse_passengers(inputs)
    rules_p = S.with_record_rule(cleansed_p, S.PASSENGER_RULES)
    reasons_p = list(dict.fromkeys(r.reason for r in rules_p))
    staged_p = paths.staged("classified_passengers")
    seen_p = write_parquet(classify(cleansed_p, rules_p), staged_p, metrics=landing_counts(reasons_p))
    cp = read_parquet(spark, staged_p)
    seen_p |= write_parquet(S.dedupe_passengers(cp), paths.passengers, metrics=silver_counts())
    write_parquet(quarantine(cp, PASSENGER_COLUMNS, keep=S.kept_columns(cp)), paths.quarantine_passengers)

    silver_b = read_parquet(spark, paths.bookings, latest_b.schema)  # without rows there is no folder to infer it from
    silver_p = read_parquet(spark, paths.passengers)
    rows = [
        ("routes", "silver_rows", None, seen_r["silver_rows"]),
        *observed_metrics("bookings", seen_b, reasons_b),
        *observed_metrics("passengers", seen_p, reasons_p),
    ]
    write_metrics_json(spark.createDataFrame(rows, METRIC_SCHEMA), paths.metrics)
    return paths, (silver_b, silver_p, routes)


def read_silver_star(spark: SparkSession, paths: SilverPaths, frames=None) -> T.Star:
    """Star over the written silver (``frames`` reuses already-opened silver tables)."""
    silver_b, silver_p, routes = frames or (
        read_parquet(spark, paths.bookings),
        read_parquet(spark, paths.passengers),
        read_parquet(spark, paths.routes),
    )
    return T.build_star(T.stg_bookings(silver_b), T.stg_passengers(silver_p), T.stg_routes(routes))


STAR_TABLES = (
    "dim_date", "dim_route", "dim_passenger", "fact_bookings",
    "mart_daily_route_revenue", "mart_revenue_by_loyalty_tier",
)


def write_star(spark: SparkSession, star: T.Star, run_dir: str) -> T.Star:
    """Write dims first, rebuild the fact and marts from the *written* dims, return read-backs."""
    write_parquet(star.dim_date, _p(run_dir, "dim_date"))
    write_parquet(star.dim_route, _p(run_dir, "dim_route"))
    write_parquet(star.dim_passenger, _p(run_dir, "dim_passenger"))
    dates = read_parquet(spark, _p(run_dir, "dim_date"))
    dim_r = read_parquet(spark, _p(run_dir, "dim_route"))
    dim_p = read_parquet(spark, _p(run_dir, "dim_passenger"))
    write_parquet(T.build_fact_bookings(star.stg_bookings, dim_p, dim_r), _p(run_dir, "fact_bookings"))
    fact = read_parquet(spark, _p(run_dir, "fact_bookings"))
    write_parquet(T.build_mart_daily_route_revenue(fact, dates, dim_r), _p(run_dir, "mart_daily_route_revenue"))
    write_parquet(T.build_mart_revenue_by_loyalty_tier(fact, dim_p, dates), _p(run_dir, "mart_revenue_by_loyalty_tier"))
    return T.Star(
        stg_bookings=star.stg_bookings,
        stg_passengers=star.stg_passengers,
        stg_routes=star.stg_routes,
        **{t: read_parquet(spark, _p(run_dir, t)) for t in STAR_TABLES},
    )


def publish(
    spark: SparkSession, inputs: S.SilverInputs, root: str, run_id: str | None = None, database: str | None = None
) -> dict:
    """Full rebuild in a run directory of its own; raises ``QualityGateError`` (publishing nothing) on
    failure, and ``ValueError`` for a ``run_id`` that was published before.

    With ``database``, the run's tables get names in the session's catalog too (``register_tables``); it and ``run_id``
    then hold letters, digits and ``_`` alone, as the catalog's names do (else ``ValueError``, before any work)."""
    run_id = run_id or uuid.uuid4().hex[:12]
    if database and not re.fullmatch(r"\w+", f"{database}{run_id}", re.ASCII):
        raise ValueError(f"{database!r} or {run_id!r} is no part of a catalog name")
    run_dir = _p(root, "runs", run_id)
    if not published_runs(spark, root).where(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run {run_id} is published already")
    paths, frames = build_silver(spark, inputs, run_dir)
    star = write_star(spark, read_silver_star(spark, paths, frames), run_dir)
    summary = Q.dq_summary(star)
    write_parquet(summary, _p(run_dir, "_checks"))
    gate(read_parquet(spark, _p(run_dir, "_checks")))
    pointer = spark.range(1, numPartitions=1).select(
        F.lit(run_id).alias("run_id"), F.lit(run_dir).alias("path"), F.current_timestamp().alias("published_at")
    )
    pointer.write.mode("append").parquet(_p(root, "current"))
    views = register_tables(spark, root, run_id, run_dir, database) if database else register_views(spark, run_dir)
    return {"run_id": run_id, "run_dir": run_dir, "silver": paths.root, "views": views}


def register_tables(spark: SparkSession, root: str, run_id: str, run_dir: str, database: str) -> list[str]:
    """Name a published run's tables in the session's catalog, and switch the views of their plain names to them.

    ``<table>__<run>`` is a table over the run's written Parquet files; it stays when later runs are published, so a run can
    be read by name as long as its folder is kept. The view ``<table>`` reads that of the run registered last. Called
    after the quality gate only. ``IF NOT EXISTS`` and ``OR REPLACE`` make a repeated call harmless."""
    location = _p(root, "catalog").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for t in STAR_TABLES:
        path = _p(run_dir, t).replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{t}__{run_id} USING parquet LOCATION '{path}'")
    for t in STAR_TABLES:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{t} AS SELECT * FROM {database}.{t}__{run_id}")
    return [f"{database}.{t}" for t in STAR_TABLES]


def register_views(spark: SparkSession, run_dir: str, prefix: str = "") -> list[str]:
    """Expose the tables of a published run as temporary views (lazy scans of the written
    Parquet), so the star can be queried with ``spark.sql``."""
    names = []
    for t in STAR_TABLES:
        read_parquet(spark, _p(run_dir, t)).createOrReplaceTempView(prefix + t)
        names.append(prefix + t)
    return names


def current_run(spark: SparkSession, root: str) -> str:
    """Directory of the last published run (the pointer has one tiny row a run)."""
    last = published_runs(spark, root).agg(F.max_by("path", "published_at").alias("path")).first()["path"]
    if last is None:
        raise LookupError(f"nothing is published below {root}")
    return last


def published_runs(spark: SparkSession, root: str) -> DataFrame:
    """``run_id``, ``path`` and ``published_at`` of every published run; empty before the first one."""
    schema = "run_id string, path string, published_at timestamp"
    at = spark._jvm.org.apache.hadoop.fs.Path(_p(root, "current"))
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_p(root, "current"))
