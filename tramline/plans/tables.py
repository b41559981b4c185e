"""Loading the driver tables and the deterministic "dirt" the quality
operators need (the driver tables are clean: no nulls, duplicates or orphan
keys). Every recipe is a pure expression of the row's own keys, so the DuckDB
oracle can write the identical rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.nulls import unify_empty

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Parquet scans prune columns and push filters down."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def every(key: str, n: int) -> Column:
    """Dirt selector: rows whose key is a multiple of ``n``."""
    return (F.col(key) % F.lit(n)) == 0


def year_ranges(col: str, years: list[int]) -> Column:
    """Membership of the date's year in a list, written as date ranges so
    the predicate reaches the parquet scan (F2 + F9)."""
    conds = [(F.col(col) >= F.lit(f"{y}-01-01").cast("timestamp_ntz"))
             & (F.col(col) < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz")) for y in years]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def dirty_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with empty cells: '' names, NULL and 'None' segments (the
    latter unified to NULL), NULL balances."""
    c = load(spark, sf_dir, "customer")
    seg = (F.when(every("c_custkey", 7), F.lit(None))
           .when(every("c_custkey", 13), F.lit("None")).otherwise(F.col("c_mktsegment")))
    return c.select(
        "c_custkey",
        F.when(every("c_custkey", 11), F.lit("")).otherwise(F.col("c_name")).alias("c_name"),
        "c_nationkey",
        F.when(every("c_custkey", 17), F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        unify_empty(seg).alias("c_mktsegment"))


def date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with the order date as 'dd.mm.yy' text, dirtied: an impossible
    day, NULLs, and a wrong layout."""
    o = load(spark, sf_dir, "orders")
    txt = F.date_format(F.col("o_orderdate"), "dd.MM.yy")
    dirty = (F.when(every("o_orderkey", 17), F.concat(F.lit("31.02."), F.substring(txt, 7, 2)))
             .when(every("o_orderkey", 19), F.lit(None).cast("string"))
             .when(every("o_orderkey", 23), F.date_format(F.col("o_orderdate"), "yyyy-MM-dd"))
             .otherwise(txt))
    return o.select("o_orderkey", dirty.alias("date_text"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly snapshots (id, jahr, label, grp, aktiv) derived from orders:
    one row per customer and order year, with attribute changes, NULLs and
    inactive years driven by the keys."""
    o = load(spark, sf_dir, "orders")
    base = o.select(F.col("o_custkey").alias("id"),
                    F.year("o_orderdate").alias("jahr")).distinct()
    idc, yc = F.col("id"), F.col("jahr")
    return base.select(
        "id", "jahr",
        F.when(idc % 13 == yc % 13, F.concat(F.lit("L"), yc.cast("string")))
         .otherwise(F.concat(F.lit("L"), (idc % 4).cast("string"))).alias("label"),
        F.when(idc % 17 == yc % 17, F.lit(None).cast("long")).otherwise(idc % 5).alias("grp"),
        ((idc + yc) % 5 != 0).alias("aktiv"))


def audit_frame(spark: SparkSession, sf_dir: str, how: str = "inner", missing_orders: int | None = None) -> DataFrame:
    """Child rows (lineitem) with their denormalised copies next to the
    parent values (orders, customer), joined along the parent path; ``yr`` is
    the parent's year, ``file_year`` the one the child is filed under.

    orders and customer are joined first (the smaller pair) so lineitem is
    shuffled once, by its order key. The copies are the parent values altered
    on a key rule, and NULL on another (a NULL copy is no mismatch under SQL
    ``!=``). With ``how="left"``, children without a parent stay, with NULL in
    ``o_orderkey``; ``missing_orders`` leaves out every n-th order.
    """
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *(["l_shipdate"] if how == "left" else []))
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    if missing_orders:
        o = o.where(~every("o_orderkey", missing_orders))
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    j = li.join(oc, li["l_orderkey"] == oc["o_orderkey"], how)
    k = F.col("l_orderkey")
    filed = ["o_orderkey", F.year("l_shipdate").alias("file_year")] if how == "left" else []
    return j.select(
        "l_orderkey", "l_linenumber", F.year("o_orderdate").alias("yr"), *filed,
        F.when(k % 7 == 0, F.col("c_custkey") + 1).otherwise(F.col("c_custkey")).alias("f_custkey"),
        "c_custkey",
        F.when(k % 11 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")).alias("f_nationkey"),
        "c_nationkey",
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .when(k % 5 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("f_orderstatus"),
        "o_orderstatus",
        F.when(F.col("l_linenumber") == 7, F.lower("c_mktsegment"))
         .otherwise(F.col("c_mktsegment")).alias("f_mktsegment"),
        "c_mktsegment")


# (name, child column, parent column) of the audited copies.
AUDIT_PAIRS = [
    ("custkey", "f_custkey", "c_custkey"),
    ("nationkey", "f_nationkey", "c_nationkey"),
    ("orderstatus", "f_orderstatus", "o_orderstatus"),
    ("mktsegment", "f_mktsegment", "c_mktsegment"),
]


def grid_coordinates(e: Column, n: Column) -> tuple[Column, Column]:
    """Swiss-grid-like coordinates as text with grouping dots
    ('2.600.000'), as the stop register stores them."""
    fmt = lambda c: F.translate(F.format_number(c, 0), ",", ".")
    return fmt(e), fmt(n)
