"""Date parsing and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# German month names, January..December.
GERMAN_MONTHS = ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli",
                 "August", "September", "Oktober", "November", "Dezember")

# Two-digit years below this value belong to the 2000s, the others to the
# 1900s (the rule of C/Python ``%y``).
YY_PIVOT = 69


def parse_dmy(c: Column) -> Column:
    """Text 'dd.mm.yy' -> DATE; anything else, or an impossible date -> NULL.

    Spark's ``yy`` maps every two-digit year into 2000-2099, so the century is
    chosen explicitly with the %y pivot before a strict four-digit parse.
    """
    ok = c.rlike(r"^[0-9]{2}\.[0-9]{2}\.[0-9]{2}$")
    yy = F.substring(c, 7, 2)
    century = F.when(yy.cast("int") >= YY_PIVOT, F.lit("19")).otherwise(F.lit("20"))
    full = F.concat(F.substring(c, 1, 6), century, yy)
    return F.when(ok, F.try_to_date(full, "dd.MM.yyyy"))


def format_dmy(d: Column) -> Column:
    """DATE -> 'dd.mm.yy'."""
    return F.date_format(d, "dd.MM.yy")


def weekday_index(d: Column) -> Column:
    """0 = Monday ... 6 = Sunday (pandas ``weekday``)."""
    return F.weekday(d)


def weekday_name(d: Column) -> Column:
    """English weekday name, e.g. 'Monday'."""
    return F.date_format(d, "EEEE")


def german_month_name(d: Column) -> Column:
    arr = F.array(*[F.lit(m) for m in GERMAN_MONTHS])
    return F.get(arr, F.month(d) - 1)


def month_length(d: Column) -> Column:
    """Days in the month of ``d`` (leap years included)."""
    return F.dayofmonth(F.last_day(d))


def dates_from_file_name(name: Column) -> tuple[Column, Column]:
    """'Fahrzeiten_SOLL_IST_20220102_20220108.csv' -> (start, end) dates.

    The last two 8-digit groups of the name are the week's first and last
    day; names without them give NULLs.
    """
    pat = r"([0-9]{8})_([0-9]{8})\.[A-Za-z]+$"
    start = F.regexp_extract(name, pat, 1)
    end = F.regexp_extract(name, pat, 2)
    fmt = "yyyyMMdd"
    return (F.try_to_date(F.nullif(start, F.lit("")), fmt),
            F.try_to_date(F.nullif(end, F.lit("")), fmt))
