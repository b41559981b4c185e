"""Catalog profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_columns, n_rows) for each named DataFrame.

    One plan: the tables are scanned without any column (parquet then reads
    only row counts), tagged with their name, unioned and counted by one
    grouping; the list of tables (one row per table) is joined to it so an
    empty table still appears with 0 rows.
    """
    spark = next(iter(tables.values())).sparkSession
    tagged = reduce(lambda a, b: a.unionByName(b),
                    [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()])
    counts = tagged.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))
    names = spark.createDataFrame([(n, len(df.columns)) for n, df in tables.items()],
                                  "table_name string, n_columns int")
    return (names.join(counts, "table_name", "left")
            .select("table_name", "n_columns", F.coalesce(F.col("n_rows"), F.lit(0)).alias("n_rows")))


def catalog_profile(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The same profile for every table and view of the session catalog."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return table_profile({n: spark.table(n) for n in names})


def sql_source(spark: SparkSession, tables: dict[str, DataFrame], sql: str) -> DataFrame:
    """Run SQL text over named frames (S13): temp views + ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
