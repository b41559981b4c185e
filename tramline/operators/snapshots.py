"""Yearly snapshot checks and merging.

A table holds one row per id and year. All checks start from ``by_id``: one
shuffle by id that gathers each id's years (rows equal in the compared columns
count once, so copies of a row are combined before the shuffle and an id's
entry holds its different rows only). Comparing a year with the next is then
an expression over that array; no year is joined to another.

Rows without an id or a year take no part in the checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_id(df: DataFrame, id_col: str, year_col: str, columns: list[str]) -> DataFrame:
    """(id, years): per id the different (y, row of ``columns``)."""
    row = F.struct(*[F.col(c) for c in columns]) if columns else F.lit(True)
    entry = F.struct(F.col(year_col).alias("y"), row.alias("row"))
    return (df.where(F.col(id_col).isNotNull() & F.col(year_col).isNotNull())
            .groupBy(id_col).agg(F.collect_set(entry).alias("years")))


def _pairs(years: Column) -> Column:
    """(x, z) for each entry x and each entry z of the year after it."""
    follow = lambda x: F.transform(F.filter(years, lambda z: z["y"] == x["y"] + 1), lambda z: F.struct(x.alias("x"), z.alias("z")))
    return F.flatten(F.transform(years, follow))


def _last_years(years: Column) -> Column:
    """The years of an id that the id's next year is missing for."""
    ys = F.transform(years, lambda x: x["y"])
    return F.array_distinct(F.filter(ys, lambda y: ~F.array_contains(ys, y + 1)))


def consecutive_pairs(df: DataFrame, id_col: str, year_col: str, columns: list[str]) -> DataFrame:
    """(id, year, c_x, c_y ...) for ids present in year and year+1."""
    p = by_id(df, id_col, year_col, columns).select(id_col, F.explode(_pairs(F.col("years"))).alias("p"))
    return p.select(id_col, F.col("p.x.y").alias(year_col), *[F.col(f"p.x.row.{c}").alias(f"{c}_x") for c in columns],
                    *[F.col(f"p.z.row.{c}").alias(f"{c}_y") for c in columns])


def changed_cells(df: DataFrame, id_col: str, year_col: str, columns: list[str]) -> DataFrame:
    """Per compared column: cells that differ between consecutive years,
    NULL = NULL being no change (Q3). Counts cells, not ids."""
    pairs = consecutive_pairs(df, id_col, year_col, columns)
    aggs = [F.count_if(~F.col(f"{c}_x").eqNullSafe(F.col(f"{c}_y"))).alias(c) for c in columns]
    wide = pairs.agg(*aggs)
    return wide.unpivot([], columns, "column_name", "inconsistent")


def ids_missing_next_year(df: DataFrame, id_col: str, year_col: str) -> DataFrame:
    """(id, year) of ids present in a year but absent in the next one, for
    every year below the last (Q4)."""
    last = df.agg(F.max(year_col)).scalar()          # scalar subquery, no join
    missing = by_id(df, id_col, year_col, []).select(id_col, F.explode(_last_years(F.col("years"))).alias(year_col))
    return missing.where(F.col(year_col) < last)


def reactivated(df: DataFrame, id_col: str, year_col: str, active_col: str) -> DataFrame:
    """(id, year) inactive in ``year`` and active in ``year + 1``."""
    pairs = consecutive_pairs(df, id_col, year_col, [active_col])
    return pairs.where(~F.col(f"{active_col}_x") & F.col(f"{active_col}_y")).select(id_col, year_col)


def latest_snapshot(df: DataFrame, id_col: str, year_col: str) -> DataFrame:
    """Each id's row of its own last year. One grouping, no window, so a hot
    id is combined map-side; among several rows of that year the largest one
    (by the other columns in order) is taken."""
    others = [c for c in df.columns if c != id_col]
    ranked = F.struct(F.col(year_col), *[F.col(c) for c in others if c != year_col])
    g = df.groupBy(id_col).agg(F.max(ranked).alias("__row"))
    return g.select(id_col, *[F.col(f"__row.{c}").alias(c) for c in others])


def last_year(df: DataFrame, year_col: str) -> DataFrame:
    """The rows of the last year, without the year: what the merge keeps of a
    table whose ids are all in it (Q12 for stops)."""
    return df.where(F.col(year_col) == df.agg(F.max(year_col)).scalar()).drop(year_col)


def stack_years(frames: dict[int, DataFrame], year_col: str = "jahr") -> DataFrame:
    """Union of yearly frames with the year as first column."""
    parts = [f.select(F.lit(y).alias(year_col), *f.columns) for y, f in sorted(frames.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merge_gate(df: DataFrame, id_col: str, year_col: str, key_columns: list[str],
               ledger: DataFrame | None = None, process: str | None = None) -> DataFrame:
    """One row (consistent, contained, unmerged, mergeable), computed from the
    rows themselves (Q11): no change in a key column, no id missing in the
    year after, and no time in the run ledger for the merge ``process`` (true
    without a ledger). Both checks read the same arrays per id."""
    last = df.agg(F.max(year_col)).scalar()
    ids = by_id(df, id_col, year_col, key_columns).withColumn("__last", last)
    changes = F.transform(_pairs(F.col("years")), lambda p: reduce(lambda a, b: a + b, [
        (~p["x"]["row"][c].eqNullSafe(p["z"]["row"][c])).cast("int") for c in key_columns]))
    gaps = F.size(F.filter(_last_years(F.col("years")), lambda y: y < F.col("__last")))
    both = ids.agg(F.coalesce(F.sum(F.aggregate(changes, F.lit(0), lambda a, b: a + b)), F.lit(0)).alias("changes"),
                   F.coalesce(F.sum(gaps), F.lit(0)).alias("gaps"))
    done = F.lit(0) if ledger is None else ledger.where((F.col("process") == process) & F.col("time").isNotNull()).agg(
        F.count(F.lit(1))).scalar()
    return both.select((F.col("changes") == 0).alias("consistent"), (F.col("gaps") == 0).alias("contained"),
                       (done == 0).alias("unmerged")).withColumn(
        "mergeable", F.col("consistent") & F.col("contained") & F.col("unmerged"))
