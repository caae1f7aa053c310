"""``classify`` / ``quarantine`` / ``accepted``: first-match validation with an ordered rule list.

A row breaking several rules is reported under the first rule that applies, so rule order is
data. Constant-list membership is an ``isin``; membership in a reference table is a left join to
the table's distinct, NULL-free keys with a hit flag (not a driver-side collect into a literal
list, and not ``NOT IN``, which a single NULL key would turn into "reject nothing"). The planner
broadcasts the key side when its size estimate is under the broadcast threshold and falls back to
a shuffle join otherwise; AQE re-plans with runtime sizes and splits skewed join keys.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cleanse import RAW_PREFIX

REASON = "reject_reason"


@dataclass(frozen=True)
class Rule:
    """One validation rule; ``violated`` gets the (possibly join-extended) frame's columns."""

    reason: str

    def prepare(self, df: DataFrame, index: int) -> DataFrame:
        return df

    def violated(self, index: int) -> Column:
        raise NotImplementedError

    def helper_columns(self, index: int) -> list[str]:
        return []


@dataclass(frozen=True)
class MissingAny(Rule):
    """Violated when any of ``columns`` is NULL (a failed cast is NULL too)."""

    columns: tuple[str, ...] = ()

    def violated(self, index: int) -> Column:
        return functools.reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.columns])


@dataclass(frozen=True)
class Present(Rule):
    """Violated when ``column`` is not NULL, such as the kept line of a row with too many or too few fields."""

    column: str = ""

    def violated(self, index: int) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class Negative(Rule):
    column: str = ""

    def violated(self, index: int) -> Column:
        return F.col(self.column) < 0


@dataclass(frozen=True)
class NotAccepted(Rule):
    """Violated when the value is NULL or outside a constant list."""

    column: str = ""
    values: tuple[str, ...] = ()

    def violated(self, index: int) -> Column:
        return F.col(self.column).isNull() | ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class NotInReference(Rule):
    """Violated when the value is NULL or absent from ``reference[ref_column]``."""

    column: str = ""
    reference: DataFrame | None = field(default=None, compare=False)
    ref_column: str = ""

    def _names(self, index: int) -> tuple[str, str]:
        return f"__ref_key_{index}", f"__ref_hit_{index}"

    def prepare(self, df: DataFrame, index: int) -> DataFrame:
        key, hit = self._names(index)
        keys = (
            self.reference.select(F.col(self.ref_column).alias(key))
            .where(F.col(key).isNotNull())
            .distinct()
            .withColumn(hit, F.lit(True))
        )
        return df.join(keys, df[self.column] == keys[key], "left")

    def violated(self, index: int) -> Column:
        return F.col(self.column).isNull() | F.col(self._names(index)[1]).isNull()

    def helper_columns(self, index: int) -> list[str]:
        return list(self._names(index))


def classify(df: DataFrame, rules: Sequence[Rule], reason_column: str = REASON) -> DataFrame:
    """All input columns plus ``reason_column``: the first violated rule's reason, else NULL."""
    out = df
    for i, rule in enumerate(rules):
        out = rule.prepare(out, i)
    verdict = None
    for i, rule in enumerate(rules):
        verdict = (F.when if verdict is None else verdict.when)(rule.violated(i), F.lit(rule.reason))
    helpers = [h for i, r in enumerate(rules) for h in r.helper_columns(i)]
    return out.select(*[F.col(c) for c in df.columns], verdict.alias(reason_column)).drop(*helpers)


def accepted(classified: DataFrame, reason_column: str = REASON) -> DataFrame:
    return classified.where(F.col(reason_column).isNull())


def quarantine(
    classified: DataFrame,
    columns: Sequence[str],
    keep: Sequence[str] = ("load_date",),
    reason_column: str = REASON,
) -> DataFrame:
    """Rejected rows with their *raw* (untrimmed, uncast) text, the kept columns and the reason."""
    return classified.where(F.col(reason_column).isNotNull()).select(
        *[F.col(RAW_PREFIX + c).alias(c) for c in columns],
        *[F.col(c) for c in keep],
        F.col(reason_column),
    )


def rejects_by_reason(classified: DataFrame, reason_column: str = REASON) -> DataFrame:
    """Rejected row count per reason (partial aggregation before the tiny shuffle)."""
    return (
        classified.where(F.col(reason_column).isNotNull())
        .groupBy(reason_column)
        .agg(F.count(F.lit(1)).alias("rejected"))
    )
