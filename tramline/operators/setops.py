"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct union of two key sets."""
    return a.unionByName(b).distinct()


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct keys present in both (U4)."""
    return a.intersect(b)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct keys of ``a`` absent from ``b``."""
    return a.subtract(b)
