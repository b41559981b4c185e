"""Numeric helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma_to_double(c: Column) -> Column:
    """'46,95' -> 46.95; text that is no number -> NULL (tolerant cast)."""
    return F.replace(c.cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def ends_with_zero_fraction(c: Column) -> Column:
    """True when the text of a whole-number double ends in '.0' (P6 test).
    NULL counts as False, as a missing value blocks narrowing."""
    return F.coalesce(c == F.floor(c), F.lit(False))


def range_category(c: Column, ranges: list[tuple[int, int, str]], other: str) -> Column:
    """Map a number to the label of the first inclusive range holding it."""
    expr = None
    for lo, hi, label in ranges:
        cond = c.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(other))


def row_max(cols: list[str]) -> Column:
    """Row-wise maximum that skips NULLs (pandas ``max(axis=1)``)."""
    return F.greatest(*[F.col(c) for c in cols])


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Python ``round`` (banker's rounding)."""
    return F.bround(c, digits)


def thousands(c: Column, decimals: int = 0, sep: str = ",") -> Column:
    """'{:,.0f}' style formatting; ``sep='.'`` for the Swiss/German style."""
    text = F.format_number(c, decimals)
    if sep == ",":
        return text
    return F.translate(text, ",.", sep + ("," if sep == "." else "."))


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)
