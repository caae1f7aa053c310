"""Text normalisation and tolerant, engine-independent casts.

A failed cast is NULL, never an error, so bad input is *reported* by the rules instead of failing
the job. ``try_cast`` alone is too tolerant and engine-specific (e.g. ``2024`` as a date, ``12:30``
as today's time, ``12.7`` as an int), so every cast is guarded by a fully anchored shape check and
anything of another shape is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text shapes before a cast.
ISO_DATE_TIME_SHAPE = (
    r"^[1-9][0-9]{3}-[0-9]{1,2}-[0-9]{1,2}"
    r"([ T]([01]?[0-9]|2[0-3]):[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]{1,9})?)?Z?)?\z"
)
DECIMAL_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
INTEGER_SHAPE = r"^[+-]?[0-9]+\z"

_SHAPES = {
    "timestamp_ntz": ISO_DATE_TIME_SHAPE,
    "date": ISO_DATE_TIME_SHAPE,
    "int": INTEGER_SHAPE,
    "bigint": INTEGER_SHAPE,
}


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """Trim ASCII spaces; an empty result becomes NULL."""
    return F.nullif(F.trim(col_(c)), F.lit(""))


def shape_for(type_name: str) -> str:
    if type_name in _SHAPES:
        return _SHAPES[type_name]
    if type_name.startswith("decimal") or type_name == "double":
        return DECIMAL_SHAPE
    raise ValueError(f"no guarded cast to {type_name}")


def guarded_cast(c: str | Column, type_name: str) -> Column:
    """``try_cast`` behind an anchored shape check: only well-formed text is cast, else NULL."""
    text = col_(c)
    return F.when(text.rlike(shape_for(type_name)), text.try_cast(type_name))


def fold_case(c: Column, case: str | None) -> Column:
    if case is None:
        return c
    if case == "upper":
        return F.upper(c)
    if case == "lower":
        return F.lower(c)
    raise ValueError(f"unknown case fold {case!r}")
