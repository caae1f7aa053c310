"""Dimensions: calendar spine, ``dim_date``, keyed reference dimensions and unknown members.

The calendar covers whole years around the dates that actually occur in the data (bounds are a
one-row global min/max aggregate, so nothing is collected to the driver). Its size is bounded by
366 rows per covered year.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import date_key


def calendar_bounds(dates: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``(start_date, end_date)``: Jan 1 of the earliest to Dec 31 of the latest year."""
    lo = F.least(*[F.min(c) for c in columns]) if len(columns) > 1 else F.min(columns[0])
    hi = F.greatest(*[F.max(c) for c in columns]) if len(columns) > 1 else F.max(columns[0])
    b = dates.agg(lo.alias("lo"), hi.alias("hi"))
    return b.select(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("end_date"),
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day from ``start_date`` to ``end_date`` inclusive (column ``date_day``)."""
    days = F.sequence(F.col("start_date"), F.col("end_date"), F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(days).alias("date_day"))


def dim_date(spine: DataFrame) -> DataFrame:
    """Calendar attributes; week is ISO, day_of_week is ISO (Monday = 1), weekend = Sat/Sun."""
    d = F.col("date_day")
    iso_dow = F.weekday(d) + 1
    return spine.select(
        date_key(d).alias("date_key"),
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        iso_dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        iso_dow.isin(6, 7).alias("is_weekend"),
    )


def unknown_member(dim: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Append one literal row (the ``-1`` member); unspecified columns are NULL of their type."""
    spark = dim.sparkSession
    row: list[Column] = []
    for field in dim.schema.fields:
        v = values.get(field.name)
        lit = F.lit(v) if not isinstance(v, Column) else v
        row.append(lit.cast(field.dataType).alias(field.name))
    return dim.unionByName(spark.range(1).select(*row))


def bucket(c: Column, bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Ordered ``value < bound -> label`` buckets; NULL and everything above fall to ``otherwise``."""
    out = None
    for bound, label in bounds:
        out = (F.when if out is None else out.when)(c < bound, F.lit(label))
    return out.otherwise(F.lit(otherwise))
