"""Repairs (P6, P13, Q2, Q7-Q10).

Each repair is an expression over the rows plus, where the original workflow
reports it, a single-aggregate metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.numbers import ends_with_zero_fraction


def period_check(df: DataFrame, date_col: str, period_col: str) -> DataFrame:
    """Rows with their true year and whether they are filed under another
    one (Q2, A30). Re-filing is a write with ``partitionBy('year')`` of the
    true year, see ``sources.sinks.write_partitioned``."""
    return df.withColumn("true_year", F.year(F.col(date_col))) \
             .withColumn("wrong_period", F.col("true_year") != F.col(period_col))


def sentinel_where(df: DataFrame, target: str, condition: Column, value) -> DataFrame:
    """Conditional overwrite (P13): ``target := value`` where ``condition``."""
    return df.withColumn(target, F.when(condition, F.lit(value)).otherwise(F.col(target)))


def add_sentinel_bearing(df: DataFrame, lat: str, lon: str, bearing: str,
                         value: float = -1.0) -> DataFrame:
    """Location known, bearing unknown -> bearing = sentinel (Q7)."""
    cond = F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(bearing).isNull()
    return sentinel_where(df, bearing, cond, value)


def keyed_patch(df: DataFrame, key: str, patches: dict[str, dict]) -> DataFrame:
    """Apply {column: {key: value}} (Q10): the patch becomes a table joined by
    key; a patched cell is overwritten whether it was NULL or not. A patch of
    any size is taken; Catalyst broadcasts it if its bytes allow."""
    spark = df.sparkSession
    keys = sorted({k for vals in patches.values() for k in vals})
    cols = list(patches)
    key_type = df.schema[key].dataType.simpleString()
    rows = [[k] + [patches[c].get(k) for c in cols] + [k in patches[c] for c in cols] for k in keys]
    schema = ", ".join([f"`__pk` {key_type}"] +
                       [f"`__pv_{i}` {df.schema[c].dataType.simpleString()}" for i, c in enumerate(cols)] +
                       [f"`__ph_{i}` boolean" for i in range(len(cols))])
    patch = spark.createDataFrame(rows, schema)
    j = df.join(patch, df[key] == F.col("__pk"), "left")
    for i, c in enumerate(cols):
        j = j.withColumn(c, F.when(F.coalesce(F.col(f"__ph_{i}"), F.lit(False)), F.col(f"__pv_{i}"))
                         .otherwise(F.col(c)))
    return j.drop("__pk", *[f"__pv_{i}" for i in range(len(cols))], *[f"__ph_{i}" for i in range(len(cols))])


def patch_from_table(df: DataFrame, key: str, patch: DataFrame, cells: str = "cells") -> DataFrame:
    """Patches from a table of any size (Q10): ``patch`` holds ``key``, the new
    values in columns named as in ``df`` and, in the array ``cells``, the names
    of the columns that a row overwrites (a listed NULL clears the cell). The
    key must be unique; rows of ``df`` without a patch stay as they are."""
    from tramline.operators.joins import assert_unique
    assert_unique(patch, [key], "patch table")
    values = [c for c in df.columns if c in patch.columns and c != key]
    p = patch.select(F.col(key).alias("__pk"), F.col(cells).alias("__cells"), *[F.col(c).alias(f"__p_{c}") for c in values])
    j = df.join(p, df[key] == p["__pk"], "left")
    listed = lambda c: F.coalesce(F.array_contains("__cells", c), F.lit(False))
    return j.select(*[F.when(listed(c), F.col(f"__p_{c}").cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
                      if c in values else F.col(c) for c in df.columns])


def narrowable(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, all_whole): may the float column become an integer (P6)?
    One aggregation; any NULL blocks narrowing."""
    wide = df.agg(*[F.bool_and(ends_with_zero_fraction(F.col(c))).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "all_whole")


def narrow_integers(df: DataFrame, columns: list[str], integer_type: str = "bigint") -> DataFrame:
    """Cast the columns whose every value is whole (two actions: a check, then
    the schema decision on the driver, as the output schema depends on the
    data)."""
    flags = {r["column_name"]: r["all_whole"] for r in narrowable(df, columns).collect()}
    for c in columns:
        if flags.get(c):
            df = df.withColumn(c, F.col(c).cast(integer_type))
    return df
