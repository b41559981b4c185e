"""Grouping, counting and profiling aggregates.

Every operator is a single aggregation (partial on the map side, final after
one shuffle on the grouping keys), with per-column results built long from
the start (one row per column) instead of a transposed wide row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.dates import weekday_index, weekday_name
from tramline.functions.nulls import is_empty


def group_count(df: DataFrame, keys: list[str] | str, name: str = "n") -> DataFrame:
    """Rows per key."""
    keys = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, col: str | Column, name: str = "n", alias: str | None = None) -> DataFrame:
    """Counts of each non-null value, largest first."""
    c = F.col(col) if isinstance(col, str) else col
    alias = alias or (col if isinstance(col, str) else "value")
    return (df.select(c.alias(alias)).where(F.col(alias).isNotNull())
            .groupBy(alias).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), F.col(alias)))


def _long(df: DataFrame, columns: list[str], value: str = "value") -> DataFrame:
    """(column_name, value as text) for every cell of ``columns``."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias(value))
             for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("__p")).select("__p.*")


def _per_column_groups(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_distinct, n_rows) with NULL counted as a value.

    One grouping per column on its own typed key, combined by a union: each
    branch reads only its column from the columnar source (so the table is
    still read once in total), groups without any text conversion, and
    -0.0/0.0 and NaNs are normalised by Spark's grouping.
    """
    parts = [df.groupBy(F.col(c).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
               .agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("__c").alias("n_rows"))
               .select(F.lit(c).alias("column_name"), "n_distinct", "n_rows")
             for c in columns]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _typed_cell(df: DataFrame, i: int, c: str) -> Column:
    """A cell as (column number, whole number, number, digest): one of the
    three holds the value, none for NULL. Text and other types are grouped by
    128 bits of their text, so long values are not shuffled."""
    kind, v = df.schema[c].dataType, F.col(f"`{c}`")
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType))
    real = isinstance(kind, (T.FloatType, T.DoubleType))
    text = v.cast("string") if not isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else F.to_json(F.struct(v))
    digest = F.when(v.isNotNull(), F.unhex(F.md5(v if isinstance(kind, T.BinaryType) else text.cast("binary"))))
    return F.struct(F.lit(i).alias("i"), (v.cast("long") if whole else F.lit(None).cast("long")).alias("l"),
                    (v.cast("double") if real else F.lit(None).cast("double")).alias("d"),
                    (F.lit(None).cast("binary") if whole or real else digest).alias("s"))


def _cell_groups(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_distinct, n_rows) with NULL counted as a value, in one
    pass over ``df``: every row gives a cell per column, equal cells are
    combined per task before the one shuffle. For frames that are dear to
    compute (joins, text parsing): their plan runs once, not once per column."""
    cells = df.select(F.explode(F.array(*[_typed_cell(df, i, c) for i, c in enumerate(columns)])).alias("x")).select("x.*")
    groups = cells.groupBy("i", "l", "d", "s").agg(F.count(F.lit(1)).alias("c"))
    per = groups.groupBy("i").agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("c").alias("n_rows"))
    names = F.array(*[F.lit(c) for c in columns])
    return per.select(F.element_at(names, F.col("i") + 1).alias("column_name"), "n_distinct", "n_rows")


def distinct_counts(df: DataFrame, columns: list[str] | None = None,
                    null_is_value: bool = True, one_pass: bool = False) -> DataFrame:
    """Exact number of distinct values per column (A3), NULL counted as a
    value like pandas ``unique()`` (or not, with ``null_is_value=False``).
    ``one_pass`` for derived frames (see ``_cell_groups``); a stored columnar
    table is better read by column."""
    columns = columns or df.columns
    if not null_is_value:
        parts = [df.agg(F.count_distinct(F.col(c)).alias("n_distinct"))
                   .select(F.lit(c).alias("column_name"), "n_distinct") for c in columns]
        return reduce(lambda a, b: a.unionByName(b), parts)
    groups = _cell_groups if one_pass else _per_column_groups
    return groups(df, columns).select("column_name", "n_distinct")


def approx_distinct_counts(df: DataFrame, columns: list[str] | None = None,
                           rsd: float = 0.01) -> DataFrame:
    """HyperLogLog++ estimate per column: one pass, no shuffle of values."""
    columns = columns or df.columns
    row = df.agg(*[F.approx_count_distinct(F.col(c), rsd).alias(c) for c in columns])
    return row.unpivot([], columns, "column_name", "n_distinct")


def unique_profile(df: DataFrame, columns: list[str] | None = None, one_pass: bool = False) -> DataFrame:
    """Distinct count per column and whether every row is distinct (A4).
    The row total is the sum of the group sizes, so no second pass is
    needed; ``one_pass`` as for ``distinct_counts``."""
    columns = columns or df.columns
    groups = _cell_groups if one_pass else _per_column_groups
    return groups(df, columns).select(
        "column_name", "n_distinct", (F.col("n_distinct") == F.col("n_rows")).alias("is_unique"))


def _is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def _empty(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    return is_empty(F.col(c), isinstance(dt, T.StringType), isinstance(dt, (T.FloatType, T.DoubleType)))


def empty_profile(df: DataFrame, columns: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Per column: empty cells (NULL, or '' in text columns) and their share
    of all rows in percent (A5). One pass."""
    columns = columns or df.columns
    aggs = [F.count_if(_empty(df, c)).alias(c) for c in columns]
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *aggs)
    long = wide.unpivot(["__n"], columns, "column_name", "empty_cells")
    return long.select("column_name", F.col("empty_cells").cast("long").alias("empty_cells"),
                       F.round(F.when(F.col("__n") > 0, F.col("empty_cells") * 100.0 / F.col("__n")), digits)
                       .alias("percentage"))


def empty_profile_split(df: DataFrame, condition: Column, columns: list[str] | None = None,
                        labels=("empty_when_true", "empty_when_false")) -> DataFrame:
    """Empty cells per column, split by a row condition."""
    columns = columns or df.columns
    aggs = []
    for c in columns:
        e = _empty(df, c)
        aggs.append(F.count_if(e & condition).alias(f"{c}__t"))
        aggs.append(F.count_if(e & ~F.coalesce(condition, F.lit(False))).alias(f"{c}__f"))
    wide = df.agg(*aggs)
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__t").alias(labels[0]),
                      F.col(f"{c}__f").alias(labels[1])) for c in columns]
    return wide.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def empty_total(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Total empty cells of a table (A7): one row."""
    columns = columns or df.columns
    total = sum((F.count_if(_empty(df, c)) for c in columns), F.lit(0))
    return df.agg(total.cast("long").alias("empty_cells"))


def boolean_share(df: DataFrame, condition: Column, digits: int = 4) -> DataFrame:
    """Rows meeting / not meeting a condition and the share in percent."""
    return (df.agg(F.count_if(condition).alias("n_true"),
                   F.count_if(~condition).alias("n_false"),
                   F.count(F.lit(1)).alias("__n"))
            .select("n_true", "n_false",
                    F.round(F.when(F.col("__n") > 0, F.col("n_true") * 100.0 / F.col("__n")), digits)
                    .alias("pct_true")))


def date_rollup(df: DataFrame, date_col: str, name: str = "n") -> DataFrame:
    """Totals per (year, month, day) with the year total, month totals and the
    grand total on rollup rows (A12); ``level`` is Spark's grouping id."""
    d = F.to_date(F.col(date_col))
    base = df.select(F.year(d).alias("yr"), F.month(d).alias("mon"), F.dayofmonth(d).alias("dom"))
    return (base.rollup("yr", "mon", "dom")
            .agg(F.count(F.lit(1)).alias(name), F.grouping_id().cast("int").alias("level")))


def weekday_totals(df: DataFrame, date_col: str, name: str = "n") -> DataFrame:
    """Rows per weekday, Monday first."""
    d = F.to_date(F.col(date_col))
    return (df.select(weekday_index(d).alias("weekday_num"), weekday_name(d).alias("weekday"))
            .groupBy("weekday_num", "weekday").agg(F.count(F.lit(1)).alias(name))
            .orderBy("weekday_num"))


def daily_series(df: DataFrame, date_col: str, name: str = "n") -> DataFrame:
    """Rows per day with month, day of month, day of year and a weekend flag
    (A14, F9, X11)."""
    d = F.to_date(F.col(date_col)).alias("day")
    g = df.select(d).groupBy("day").agg(F.count(F.lit(1)).alias(name))
    return g.select("day", F.year("day").alias("yr"), F.month("day").alias("mon"),
                    F.dayofmonth("day").alias("dom"), F.dayofyear("day").alias("doy"),
                    (weekday_index(F.col("day")) >= 5).alias("is_weekend"), name)
