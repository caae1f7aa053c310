"""Registered data-quality queries: one row per check ``(check_name, target, violations)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import quality as Q
from . import silver as S
from . import star as T
from .registry import query


def _star(spark: SparkSession, sf_dir: str) -> T.LazyStar:
    """Checks read star tables several times: each table a check needs is written once to the
    shared scratch folder on first use and read back."""
    inputs = S.landing_inputs(spark, sf_dir)
    return T.LazyStar(
        T.stg_bookings(S.silver_bookings(inputs)),
        T.stg_passengers(S.silver_passengers(inputs)),
        T.stg_routes(S.silver_routes(inputs)),
    )


def _register(name: str, check) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return check(_star(spark, sf_dir))

    run.__name__ = f"q_{name}"
    run.__doc__ = check.__doc__
    query(name)(run)


for _name, _check in [
    ("dq_unique", Q.dq_unique),
    ("dq_not_null", Q.dq_not_null),
    ("dq_accepted_values", Q.dq_accepted_values),
    ("dq_relationships", Q.dq_relationships),
    ("dq_value_in_range", Q.dq_value_in_range),
    ("dq_fact_reconciles", Q.dq_fact_reconciles),
    ("dq_known_keys_resolve", Q.dq_known_keys_resolve),
    ("dq_one_current_version", Q.dq_one_current_version),
    ("dq_scd2_overlap", Q.dq_scd2_overlap),
    ("dq_pit_containment", Q.dq_pit_containment),
    ("dq_tier_recompute", Q.dq_tier_recompute),
    ("dq_marts_reconcile", Q.dq_marts_reconcile),
    ("dq_silver_valid", Q.dq_silver_valid),
    ("dq_contiguous_versions", Q.dq_contiguous_versions),
    ("dq_summary", Q.dq_summary),
]:
    _register(_name, _check)
