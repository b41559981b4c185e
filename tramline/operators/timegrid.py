"""Gaps in a regular time grid (Q23, Q24).

The grid is generated with ``spark.range`` (distributed, one row per slot),
never as one large array in a single row, and is compared with the distinct
occupied slots by an anti join. Filling the grid per entity is reported by
arithmetic on counts (grid cells = entities x slots), so no entity x slot
cross product is materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _epoch_ntz():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _is_ntz(df: DataFrame, ts_col: str) -> bool:
    return isinstance(df.schema[ts_col].dataType, T.TimestampNTZType)


def _slot_of(df: DataFrame, ts_col: str, step_seconds: int):
    """Slot number = whole seconds since the epoch // step. Wall-clock
    (timestamp_ntz) values are measured against the wall-clock epoch, so
    the grid does not depend on the session time zone."""
    if _is_ntz(df, ts_col):
        secs = F.timestamp_diff("SECOND", _epoch_ntz(), F.col(ts_col))
    else:
        secs = F.unix_seconds(F.col(ts_col).cast("timestamp"))
    return F.floor(secs / F.lit(step_seconds)).cast("long")


def _slot_start(df: DataFrame, ts_col: str, step_seconds: int):
    secs = F.col("slot") * F.lit(step_seconds)
    if _is_ntz(df, ts_col):
        return F.timestamp_add("SECOND", secs, _epoch_ntz())
    return F.timestamp_seconds(secs)


def occupied_slots(df: DataFrame, ts_col: str, step_seconds: int) -> DataFrame:
    return df.select(_slot_of(df, ts_col, step_seconds).alias("slot")).where("slot IS NOT NULL").distinct()


def grid_bounds(df: DataFrame, ts_col: str, step_seconds: int) -> tuple[int, int]:
    """First and last slot of the data (one small aggregate)."""
    s = _slot_of(df, ts_col, step_seconds)
    row = df.agg(F.min(s).alias("lo"), F.max(s).alias("hi")).first()
    return row["lo"], row["hi"]


def missing_slots(df: DataFrame, ts_col: str, step_seconds: int,
                  bounds: tuple[int, int] | None = None) -> DataFrame:
    """Start timestamps (UTC) of grid slots without any row (Q23)."""
    spark = df.sparkSession
    lo, hi = bounds or grid_bounds(df, ts_col, step_seconds)
    if lo is None:
        return spark.createDataFrame([], "slot_start timestamp_ntz" if _is_ntz(df, ts_col) else "slot_start timestamp")
    grid = spark.range(lo, hi + 1).withColumnRenamed("id", "slot")
    missing = grid.join(occupied_slots(df, ts_col, step_seconds), "slot", "left_anti")
    return missing.select(_slot_start(df, ts_col, step_seconds).alias("slot_start"))


def missing_summary(df: DataFrame, ts_col: str, step_seconds: int) -> DataFrame:
    """One row: slots in the grid, missing slots, share in whole percent."""
    lo, hi = grid_bounds(df, ts_col, step_seconds)
    n_slots = 0 if lo is None else hi - lo + 1
    m = missing_slots(df, ts_col, step_seconds, (lo, hi))
    return m.agg(F.lit(n_slots).cast("long").alias("grid_slots"),
                 F.count(F.lit(1)).alias("missing"),
                 F.round(F.count(F.lit(1)) * 100.0 / F.lit(max(n_slots, 1)), 0).alias("missing_pct"))


def missing_by(df: DataFrame, ts_col: str, step_seconds: int, part: str) -> DataFrame:
    """Missing slots per hour (0-23), weekday (0 = Monday), month (1-12) or
    year."""
    m = missing_slots(df, ts_col, step_seconds)
    t = F.col("slot_start")
    parts = {"hour": F.hour(t), "weekday": F.weekday(t), "month": F.month(t), "year": F.year(t)}
    return m.groupBy(parts[part].alias(part)).agg(F.count(F.lit(1)).alias("missing"))


def grid_fill_counts(df: DataFrame, ts_col: str, step_seconds: int, entity: str,
                     value: str | None = None) -> DataFrame:
    """Zero rows before and after filling the entity x slot grid (Q24).

    Before: observed (entity, slot) cells whose value sum is 0. After: those
    plus every grid cell with no row at all, which is
    entities x slots - observed cells.
    """
    s = _slot_of(df, ts_col, step_seconds)
    v = F.col(value) if value else F.lit(1)
    cells = (df.select(F.col(entity), s.alias("slot"), v.alias("v"))
             .groupBy(entity, "slot").agg(F.sum("v").alias("v")))
    stats = cells.agg(F.count(F.lit(1)).alias("observed"),
                      F.count_if(F.coalesce(F.col("v"), F.lit(0)) == 0).alias("zero_before"),
                      F.count_distinct(F.col(entity)).alias("entities"),
                      F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    grid = F.col("entities") * (F.col("hi") - F.col("lo") + 1)
    return stats.select(grid.cast("long").alias("grid_cells"), "observed", "zero_before",
                        (F.col("zero_before") + grid - F.col("observed")).cast("long").alias("zero_after"))
