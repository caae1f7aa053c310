"""Every registered query equals its independent DuckDB SQL (sf0.001: small and fast)."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

import __spark_entry__ as E
from lakesmith.plans.registry import all_queries

NAMES = sorted(all_queries())


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "gross_revenue" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(spark, duck_small, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert r["status"] == "OK", r
