"""``dedupe_latest``: keep the newest version of every key.

Expressed as ``row_number() over (partition by key order by ...) = 1`` so Catalyst plans it as a
*partial* WindowGroupLimit before the shuffle and a final one after it: a key with millions of
copies is cut to one row per map task before anything moves, so a hot key cannot flood one
reducer. The order is made total by appending every remaining column (ascending, NULLs last),
which makes the survivor deterministic even among rows that tie on the stated order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "__version_rank"


def _order(columns: Sequence[str], stated: Sequence[tuple[str, bool]], keys: Sequence[str]) -> list[Column]:
    order = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c, desc in stated]
    used = set(keys) | {c for c, _ in stated}
    order += [F.col(c).asc_nulls_last() for c in columns if c not in used]
    return order


def latest_window(columns: Sequence[str], keys: Sequence[str], order: Sequence[tuple[str, bool]]):
    return Window.partitionBy(*keys).orderBy(*_order(columns, order, keys))


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]]) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (``(column, descending)`` pairs)."""
    w = latest_window(df.columns, keys, order)
    return df.withColumn(RANK, F.row_number().over(w)).where(F.col(RANK) == 1).drop(RANK)


def superseded(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]]) -> DataFrame:
    """The complement of :func:`dedupe_latest`: every version that lost to a newer one."""
    w = latest_window(df.columns, keys, order)
    return df.withColumn(RANK, F.row_number().over(w)).where(F.col(RANK) > 1).drop(RANK)
