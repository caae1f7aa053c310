"""Query registry: ``name -> fn(spark, sf_dir) -> DataFrame`` for every implemented operator.

Every registered query reads the driver tables below ``sf_dir`` (directly or through the landing
views derived from them) and runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn

    return register


def all_queries() -> dict[str, QueryFn]:
    # importing the modules registers their queries
    from . import (  # noqa: F401
        queries_checks,
        queries_io,
        queries_late,
        queries_native,
        queries_silver,
        queries_star,
        queries_streaming,
    )

    return dict(QUERIES)
