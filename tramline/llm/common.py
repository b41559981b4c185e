"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize, scratch_path  # noqa: F401  (re-exported for the operators)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces allowed)."""
    return F.col(f"`{name}`")


def packed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The whole input row as one struct ``row`` beside the columns that the
    operators work on (``id``, ``text``, ``h``), so that no extra input column
    can clash with a working column. ``h`` tells rows apart that share an id;
    rows equal in id and text count as one document."""
    row = F.struct(*[col(c) for c in df.columns]).alias("row")
    return df.select(row, col(id_col).alias("id"), col(text_col).alias("text"),
                     F.xxhash64(col(text_col)).alias("h"))


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """Back to the input's columns; ``replaced`` gives new values by name."""
    return df.select(*[replaced.get(c, F.col("row").getField(c)).alias(c) for c in columns])
