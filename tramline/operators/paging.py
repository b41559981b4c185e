"""Pages of a sorted table at any depth.

``ordering.page`` is a distributed top-(page * size): right for the first
pages, but page n gathers n * size rows. A ``PageIndex`` sorts the table once
into range partitions with their first row numbers; a page then reads only the
partitions its rows lie in, and of those only the row groups that hold them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators.ordering import partition_offsets, sorted_tags

ROW = "__row_no"


class PageIndex:
    """A sorted copy of a table at ``path``: folders ``rows/__pid=<p>``, sorted
    by row number, and ``starts`` (one row per partition)."""

    def __init__(self, spark: SparkSession, path: str):
        """Open an index that ``build`` has written."""
        self.spark, self.path = spark, path.rstrip("/")
        # one row per range partition of the writer: bounded by its partition count
        starts = spark.read.parquet(f"{self.path}/starts").collect()
        self.schema = T.StructType.fromJson(json.loads(starts[0]["schema"]))
        self.columns = self.schema.names
        self.starts = sorted((r["pid"], r["first"]) for r in starts if r["n"])
        self.n_rows = sum(r["n"] for r in starts)

    @classmethod
    def build(cls, df: DataFrame, order_cols: list[str], path: str, n_partitions: int | None = None) -> PageIndex:
        """Sort ``df`` by ``order_cols`` (NULLs first) and write the index.
        Ties get an arbitrary but fixed order, so pages never overlap."""
        path = path.rstrip("/")
        tagged = sorted_tags(df, order_cols, n_partitions)
        off = partition_offsets(tagged, F.count(F.lit(1)))
        inside = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
        numbered = tagged.join(F.broadcast(off), "__pid").withColumn(ROW, F.col("__off") + inside)
        # a range partition is one task's rows; the sort inside it makes row groups of consecutive rows
        (numbered.repartition("__pid").sortWithinPartitions("__pid", ROW).select(*df.columns, ROW, "__pid")
         .write.mode("errorifexists").partitionBy("__pid").parquet(f"{path}/rows"))
        counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(off), "__pid").collect()
        rows = [(r["__pid"], r["__off"], r["n"], df.schema.json()) for r in counts] or [(0, 0, 0, df.schema.json())]
        # written last: an index without it was not finished
        (df.sparkSession.createDataFrame(rows, "pid int, first long, n long, schema string").coalesce(1)
         .write.mode("errorifexists").parquet(f"{path}/starts"))
        return cls(df.sparkSession, path)

    def rows(self, first: int, n: int) -> DataFrame:
        """Rows ``first`` .. ``first + n - 1`` (0-based), in order."""
        last = first + n - 1
        ends = [*[a - 1 for _, a in self.starts[1:]], self.n_rows - 1]
        hit = [p for (p, a), b in zip(self.starts, ends) if a <= last and b >= first]
        if not hit:
            return self.spark.createDataFrame([], self.schema)
        whole = T.StructType([*self.schema.fields, T.StructField(ROW, T.LongType()), T.StructField("__pid", T.IntegerType())])
        df = self.spark.read.schema(whole).parquet(f"{self.path}/rows").where(F.col("__pid").isin(hit))
        return df.where(F.col(ROW).between(first, last)).orderBy(ROW).select(*self.columns)

    def page(self, page_no: int, size: int = 10) -> DataFrame:
        """Page ``page_no`` (1-based) of ``size`` rows; empty behind the end."""
        return self.rows((page_no - 1) * size, size)
