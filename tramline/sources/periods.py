"""A table filed by period, re-filed by rewriting only what changes (Q2).

Data lies below ``<base>/<name>/data/v=<version>/<by>=<period>/``. A version
is a manifest, a small table that says for every period which version's folder
holds it; readers take the newest manifest. So a new version is committed by
one small write, rewrites only the periods that change, and a run that stops
before leaves the table as it was. Older versions stay readable.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.sources.sinks import version_stamp


class PeriodTable:
    """A table filed by the column ``by`` (one folder per value)."""

    def __init__(self, spark: SparkSession, base: str, name: str, by: str):
        self.spark, self.by = spark, by
        self.root = f"{base.rstrip('/')}/{name}"

    # One row per period of the table: years, weeks or days, a bounded list.
    def _manifests(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/manifest")

    def version(self) -> str:
        return self._manifests().agg(F.max("version")).first()[0]

    def files(self, version: str | None = None) -> dict:
        """{period: version of the folder that holds it}"""
        at = version or self.version()
        rows = self._manifests().where((F.col("version") == at) & F.col("holds").isNotNull()).select("period", "holds").collect()
        return {r["period"]: r["holds"] for r in rows}

    def schema(self, version: str | None = None) -> T.StructType:
        at = version or self.version()
        row = self._manifests().where((F.col("version") == at) & F.col("schema").isNotNull()).select("schema").first()
        return T.StructType.fromJson(json.loads(row["schema"]))

    def read(self, version: str | None = None, periods: list | None = None) -> DataFrame:
        """The rows of a version (the newest one by default), of some periods
        only if given; one scan over the folders it names."""
        held = {p: v for p, v in self.files(version).items() if periods is None or p in periods}
        paths = [self._folder(v, p) for p, v in sorted(held.items(), key=lambda x: str(x[0]))]
        schema = self.schema(version)
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])

    def _folder(self, version: str, period) -> str:
        value = "__HIVE_DEFAULT_PARTITION__" if period is None else period
        return f"{self.root}/data/v={version}/{self.by}={value}"

    def write(self, df: DataFrame, keep: dict | None = None, version: str | None = None) -> str:
        """A new version: the rows of ``df`` in folders of their own; ``keep``
        ({period: version}) are periods taken over as they are. The manifest
        is written last and makes the version visible."""
        stamp = version or f"v{version_stamp()}"
        path = f"{self.root}/data/v={stamp}"
        # dealt by period, large periods to many tasks
        df.hint("rebalance", F.col(self.by)).write.mode("errorifexists").partitionBy(self.by).parquet(path)
        kind = df.schema[self.by].dataType.simpleString()
        # periods that got rows, from the folders' names: no second pass over the rows
        whole = T.StructType([f for f in df.schema.fields if f.name != self.by] + [df.schema[self.by]])
        fresh = [r[0] for r in self.spark.read.schema(whole).parquet(path).select(self.by).distinct().collect()]
        rows = [(p, stamp, None) for p in fresh] + [(p, v, None) for p, v in (keep or {}).items() if p not in set(fresh)]
        rows.append((None, None, df.schema.json()))                 # an empty table has a version, too
        manifest = self.spark.createDataFrame(rows, f"period {kind}, holds string, schema string").withColumn("version", F.lit(stamp))
        manifest.coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return stamp

    def refile(self, true_period, version: str | None = None) -> DataFrame | None:
        """File every row under ``true_period`` (a column expression). Returns
        (old_period, new_period, n) for the rows that moved, or None if none
        had to: then nothing is written, so a second run changes nothing. Rows
        whose true period is NULL stay where they are.

        One pass finds the moves, a small table of period pairs; a second one
        reads and rewrites the periods that lose or gain rows, no others."""
        held, by = self.files(), F.col(self.by)
        now = self.read()
        kind = now.schema[self.by].dataType
        true = F.coalesce(true_period.cast(kind), by)
        moves = [tuple(r) for r in now.select(by.alias("o"), true.alias("t")).where(~F.col("o").eqNullSafe(F.col("t")))
                 .groupBy("o", "t").agg(F.count(F.lit(1)).alias("n")).collect()]
        if not moves:
            return None
        touched = {p for o, t, _ in moves for p in (o, t)}
        rows = self.read(periods=[p for p in touched if p in held]).withColumn(self.by, true)
        self.write(rows, {p: v for p, v in held.items() if p not in touched}, version)
        return self.spark.createDataFrame(moves, f"old_period {kind.simpleString()}, new_period {kind.simpleString()}, n long")
