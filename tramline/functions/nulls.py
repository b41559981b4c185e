"""Missing-value handling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole-cell texts that mean "missing" in the source files.
EMPTY_MARKERS = ("", "None", "Null")


def unify_empty(c: Column, markers=EMPTY_MARKERS) -> Column:
    """Whole-cell sentinel text -> NULL; other values unchanged."""
    return F.when(c.isin(*markers), F.lit(None)).otherwise(c)


def is_empty(c: Column, string_like: bool = True, floating: bool = False) -> Column:
    """NULL, the empty string for text columns, NaN for floating-point
    columns (all three are 'missing' to the profilers)."""
    if string_like:
        return c.isNull() | (c == F.lit(""))
    if floating:
        return c.isNull() | F.isnan(c)
    return c.isNull()


def all_not_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
