"""Projections and schema changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.text import literal_replace


def apply_operations(df: DataFrame, operations: list[str]) -> DataFrame:
    """Apply a declarative list 'RENAME a TO b' / 'DROP a' /
    'REPLACE AT col old WITH new' (P1, P1b, X1). A rename or drop of a column
    that is absent is skipped, like the SQL variant that checks first."""
    renames = {}
    for op in operations:
        parts = op.split(" ")
        if parts[0] == "RENAME":
            src, dst = parts[1], parts[-1]
            if src in renames.values() or dst in renames:
                df, renames = df.withColumnsRenamed(renames), {}
            if src in df.columns:
                renames[src] = dst
        elif parts[0] == "DROP":
            if renames:
                df, renames = df.withColumnsRenamed(renames), {}
            df = df.drop(parts[1])
        elif parts[0] == "REPLACE":
            if renames:
                df, renames = df.withColumnsRenamed(renames), {}
            col, old = parts[2], parts[3]
            new = parts[5] if len(parts) > 5 else ""
            df = df.withColumn(col, literal_replace(F.col(col), old, new))
        else:
            raise ValueError(f"unknown operation: {op}")
    return df.withColumnsRenamed(renames) if renames else df


def with_leading_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant column in front."""
    return df.select(F.lit(value).alias(name), *[c for c in df.columns if c != name])


def keep_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep only the named columns, in the given order."""
    return df.select(*[c for c in columns if c in df.columns])


def conform(df: DataFrame, schema: T.StructType, safe: bool = True, rescue: str | None = None,
            record: str | None = None) -> DataFrame:
    """Cast the columns to a declared schema (P5). ``safe`` uses try_cast, so
    a bad cell becomes NULL instead of failing the job under ANSI mode.

    ``rescue`` names a column that keeps what such a cast loses: an array of
    (column_name, value) with each cell that holds a value and has none of the
    declared type, empty if all fit. ``record`` names a column with the raw
    text of malformed records; it joins the array without a column name."""
    cols, lost = [], []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f"`{f.name}`")
            fit = c.try_cast(f.dataType) if safe or rescue else c.cast(f.dataType)
            cols.append(fit.alias(f.name))
            if rescue and df.schema[f.name].dataType != f.dataType:
                lost.append(F.when(c.isNotNull() & fit.isNull(), F.struct(
                    F.lit(f.name).alias("column_name"), c.cast("string").alias("value"))))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if rescue:
        if record:
            lost.append(F.when(F.col(f"`{record}`").isNotNull(), F.struct(
                F.lit(None).cast("string").alias("column_name"), F.col(f"`{record}`").alias("value"))))
        cells = F.filter(F.array(*lost), lambda x: x.isNotNull()) if lost else F.array()
        cols.append(cells.cast("array<struct<column_name:string,value:string>>").alias(rescue))
    return df.select(*cols)


def unpivot(df: DataFrame, ids: list[str], values: list[str], var: str, val: str) -> DataFrame:
    """Wide -> long (P10, ``melt``)."""
    return df.unpivot(ids, values, var, val)


def drop_if_clean(df: DataFrame, check: DataFrame, count_col: str, columns: list[str]) -> DataFrame:
    """Drop redundant columns only when a check found no violation.

    ``check`` is a one-row aggregate (e.g. ``date_disagreement``); reading
    its count is the single action; the output schema is decided on the
    driver because it depends on the data."""
    violations = check.select(count_col).first()[0]
    return df.drop(*columns) if violations == 0 else df


def map_batches(df: DataFrame, fn, schema: str | T.StructType) -> DataFrame:
    """Apply a user function ``pandas.DataFrame -> pandas.DataFrame`` to
    Arrow batches of each partition (D1). For user-supplied logic only; the
    library's own operators are column expressions."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)
