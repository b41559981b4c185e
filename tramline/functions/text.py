"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_replace(c: Column, old: str, new: str) -> Column:
    """Replace every literal occurrence of ``old`` (never a regex, so ``.``
    means a dot)."""
    return F.replace(c, F.lit(old), F.lit(new))


def strip_grouping_dots(c: Column) -> Column:
    """'2.600.000' -> '2600000' (X18)."""
    return F.replace(c, F.lit("."), F.lit(""))


def split_once(c: Column, sep: str) -> tuple[Column, Column]:
    """Split at the first ``sep`` into (head, rest); rest is NULL without a
    separator. ANSI-safe (``get`` instead of ``[]``)."""
    parts = F.split(c, _regex_literal(sep), 2)
    return F.get(parts, 0), F.get(parts, 1)


def first_token(c: Column, sep: str = ",") -> Column:
    """Text before the first ``sep`` (the whole text if there is none)."""
    return F.split_part(c, F.lit(sep), F.lit(1))


def words(c: Column, sep: str = ",") -> Column:
    """Array of trimmed tokens; use with ``explode``."""
    return F.transform(F.split(c, _regex_literal(sep)), lambda t: F.trim(t))


def capitalize(c: Column) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def search_match(c: Column, pattern: str, negate: bool = False) -> Column:
    """Regex contained anywhere in the text of a column (F3). A NULL cell
    is searched as the empty string, so NOT-filters keep it."""
    hit = F.coalesce(c.cast("string"), F.lit("")).rlike(pattern)
    return ~hit if negate else hit


def _regex_literal(s: str) -> str:
    import re
    return re.escape(s)
