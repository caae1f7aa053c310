"""Deterministic keys: md5 surrogate keys and integer ``yyyyMMdd`` date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

UNKNOWN_KEY = "-1"


def iso_date_text(c: str | Column) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd")


def surrogate_key(*parts: str | Column) -> Column:
    """``md5(p1 || '|' || p2 ...)`` over text parts; NULL if any part is NULL."""
    separated = [x for p in parts for x in (F.lit("|"), col_(p).cast("string"))][1:]
    return F.md5(F.concat(*separated))


def date_key(c: str | Column) -> Column:
    """Integer ``yyyyMMdd`` for a date (NULL stays NULL)."""
    return F.date_format(col_(c), "yyyyMMdd").cast("int")
