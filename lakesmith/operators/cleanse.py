"""``cleanse``: one narrow projection from raw text to typed, normalised columns.

Each output column is described by a :class:`ColumnSpec` (trim, blank handling, case fold, guarded
cast). The untouched input text is carried beside it as ``raw_<name>`` so rejected rows can later
be quarantined with exactly what arrived. No shuffle, no UDF: a single ``select`` that stays inside
whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, fold_case, guarded_cast

RAW_PREFIX = "raw_"


@dataclass(frozen=True)
class ColumnSpec:
    """How one landing text column becomes a typed column.

    ``blank_to_null``: trim, then empty text is NULL (otherwise trim only, blanks stay ``''``).
    ``case``: ``"upper"``, ``"lower"`` or None. ``cast``: a Spark type name or None (stay text).
    """

    name: str
    blank_to_null: bool = True
    case: str | None = None
    cast: str | None = None

    def expression(self):
        text = blank_to_null(self.name) if self.blank_to_null else F.trim(F.col(self.name))
        text = fold_case(text, self.case)
        if self.cast is not None:
            text = guarded_cast(text, self.cast)
        return text.alias(self.name)


def cleanse(
    landing: DataFrame,
    specs: Sequence[ColumnSpec],
    keep: Sequence[str] = (),
    raw: bool = True,
) -> DataFrame:
    """Typed columns per ``specs``, then ``keep`` columns unchanged, then ``raw_*`` shadows."""
    columns = [s.expression() for s in specs]
    columns += [F.col(c) for c in keep]
    if raw:
        columns += [F.col(s.name).alias(RAW_PREFIX + s.name) for s in specs]
    return landing.select(*columns)
