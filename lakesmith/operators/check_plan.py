"""Declared checks compiled into few passes, whatever their number.

A suite of checks that each read their tables costs a scan a check. Here checks are declared as data and
``compile_checks`` plans them together:

* *one conditional aggregate a table* counts the offending rows of all its row rules, the unexpected distinct values of its
  value checks, and its totals;
* *one key count* serves every uniqueness check and every relationship: each table gives its keys of all these checks in one scan
  (``explode`` of an array of them), grouped by (key space, key). In a group, more than one owner is a duplicate, and references
  without an owner are orphans. Equal keys collapse before the shuffle, so a hot key costs a row a task;
* totals that must agree are compared NULL-safely in a last aggregate over the handful of result rows.

The result is the same as running the checks of ``operators.checks`` one by one: a row of (check_name, target, violations) each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG = "array<struct<check_name: string, target: string, item: string, violations: bigint, total: decimal(38, 2), side: int>>"


@dataclass(frozen=True)
class RowRule:
    """The rows of ``table`` for which ``violated`` is true."""

    check: str
    target: str
    table: str
    violated: Column


@dataclass(frozen=True)
class Values:
    """The distinct values of ``column`` other than ``values``; NULL passes."""

    table: str
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Unique:
    """The values of ``column`` that several rows have; NULL passes."""

    table: str
    column: str


@dataclass(frozen=True)
class Refers:
    """The rows of ``table`` whose ``column`` no row of ``parent`` has; NULL passes."""

    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Total:
    """One of the two sides (0 and 1) of an equality ``item`` of a check; the check's violations are its unequal items.

    ``once`` counts them as one violation together."""

    check: str
    target: str
    item: str
    side: int
    table: str
    value: Column
    once: bool = False


Check = RowRule | Values | Unique | Refers | Total


def not_null(table: str, column: str) -> RowRule:
    return RowRule("not_null", f"{table}.{column}", table, F.col(column).isNull())


def in_range(table: str, column: str, lo, hi) -> RowRule:
    return RowRule("value_in_range", f"{table}.{column}", table, (F.col(column) < lo) | (F.col(column) > hi))


def found(check: str, target: str, n: Column) -> Column:
    """A result of a pass, for ``results``."""
    return _entry(check, target, "", violations=n)


def results(one_row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """The entries of a one-row frame as rows."""
    return one_row.select(F.explode(F.array(*entries).cast(LONG)).alias("r")).select("r.*")


def _entry(check: str, target: str, item: str, violations: Column | None = None, total: Column | None = None, side: int = 0) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit(check).alias("check_name"), F.lit(target).alias("target"), F.lit(item).alias("item"),
        (none if violations is None else F.coalesce(violations, F.lit(0))).cast("bigint").alias("violations"),
        (none if total is None else total).cast("decimal(38,2)").alias("total"), F.lit(side).alias("side"),
    )


def table_pass(df: DataFrame, checks: Sequence[RowRule | Values | Total]) -> DataFrame:
    """All counts and totals of one table from one conditional aggregate."""
    aggs, entries = [], []
    for i, c in enumerate(checks):
        name = f"c{i}"
        if isinstance(c, RowRule):
            aggs.append(F.count_if(c.violated).alias(name))
            entries.append(_entry(c.check, c.target, "", violations=F.col(name)))
        elif isinstance(c, Values):
            unexpected = F.when(F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.values), F.col(c.column))
            aggs.append(F.count_distinct(unexpected).alias(name))
            entries.append(_entry("accepted_values", f"{c.table}.{c.column}", "", violations=F.col(name)))
        else:
            aggs.append(c.value.alias(name))
            entries.append(_entry(c.check, c.target, c.item, total=F.col(name), side=c.side))
    return results(df.agg(*aggs), entries)


def key_pass(tables: Mapping[str, DataFrame], checks: Sequence[Unique | Refers]) -> DataFrame:
    """All uniqueness and relationship checks from one count of keys."""
    uniques = [c for c in checks if isinstance(c, Unique)]
    refers = [c for c in checks if isinstance(c, Refers)]
    owners = {(c.table, c.column) for c in uniques} | {(c.parent, c.parent_column) for c in refers}
    spaces = sorted(owners)
    wanted: dict[str, list[tuple[int, int, str]]] = {}  # table -> (space, reference or -1, column)
    for space, (table, column) in enumerate(spaces):
        wanted.setdefault(table, []).append((space, -1, column))
    for i, c in enumerate(refers):
        wanted.setdefault(c.table, []).append((spaces.index((c.parent, c.parent_column)), i, c.column))

    keys = None
    for table, entries in wanted.items():
        own = [F.struct(F.lit(s).alias("space"), F.lit(r).alias("ref"), F.col(c).cast("string").alias("key")) for s, r, c in entries]
        rows = tables[table].select(F.explode(F.array(*own)).alias("k")).select("k.*").where("key IS NOT NULL")
        rows = rows.groupBy("space", "key", "ref").agg(F.count(F.lit(1)).alias("n")) if len(entries) > 1 else rows.withColumn("n", F.lit(1).cast("bigint"))
        keys = rows.select("space", "key", "ref", "n") if keys is None else keys.unionByName(rows.select("space", "key", "ref", "n"))
    by_key = keys.groupBy("space", "key").agg(
        F.sum(F.when(F.col("ref") == -1, F.col("n"))).alias("owners"),
        *[F.sum(F.when(F.col("ref") == i, F.col("n"))).alias(f"ref{i}") for i in range(len(refers))],
    )
    counts = [F.count_if((F.col("space") == spaces.index((c.table, c.column))) & (F.col("owners") > 1)).alias(f"u{i}") for i, c in enumerate(uniques)]
    counts += [F.sum(F.when(F.col("owners").isNull(), F.col(f"ref{i}"))).alias(f"r{i}") for i in range(len(refers))]
    entries = [_entry("unique", f"{c.table}.{c.column}", "", violations=F.col(f"u{i}")) for i, c in enumerate(uniques)]
    entries += [_entry("relationships", f"{c.table}.{c.column}", "", violations=F.col(f"r{i}")) for i, c in enumerate(refers)]
    return results(by_key.agg(*counts), entries)


def compile_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check], passes: Sequence[DataFrame] = ()) -> DataFrame:
    """check_name, target and violations of every check. ``passes`` are further results (of ``results``) to go in."""
    parts = list(passes)
    for name, df in tables.items():
        own = [c for c in checks if isinstance(c, RowRule | Values | Total) and c.table == name]
        if own:
            parts.append(table_pass(df, own))
    keyed = [c for c in checks if isinstance(c, Unique | Refers)]
    if keyed:
        parts.append(key_pass(tables, keyed))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)

    side = lambda k: F.max(F.when(F.col("side") == k, F.col("total")))
    items = rows.groupBy("check_name", "target", "item").agg(
        F.sum("violations").alias("counted"), side(0).alias("left"), side(1).alias("right")
    )
    unequal = F.when(F.col("item") != "", (~F.col("left").eqNullSafe(F.col("right"))).cast("bigint")).otherwise(F.lit(0))
    out = items.groupBy("check_name", "target").agg((F.sum(F.coalesce("counted", F.lit(0)) + unequal)).alias("violations"))
    once = [f"{c.check}|{c.target}" for c in checks if isinstance(c, Total) and c.once]
    capped = F.concat_ws("|", "check_name", "target").isin(*once) if once else F.lit(False)
    return out.withColumn("violations", F.when(capped, F.least("violations", F.lit(1))).otherwise(F.col("violations")).cast("bigint"))
