"""Run ledger.

The ledger is a parquet table of (process, time, output) rows that is only
ever appended to; the current state of a process is its latest row. A step
whose process already has a recorded time is not run again.
"""

from __future__ import annotations

import time as _time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "process string, time double, output string, recorded_at timestamp"

YEAR_PROCESS = r"^([A-Za-z]+)_([0-9]{4})_(.+)$"


def ledger_rollup(ledger: DataFrame) -> DataFrame:
    """Sum per-year ledger rows into one row per (table, step).

    'Table_2019_Step' rows are grouped by (Table, Step); times are summed
    (missing = 0) and rounded to 2 digits (half to even); outputs 'k: v; k2: v2' are parsed
    and summed per key, keeping the keys' order; an output of only 'True'
    stays 'True'. One pass over the ledger: each row's time rides on its
    first output part, so times and parts are summed by the same grouping.
    """
    y = ledger.where(F.col("process").rlike(YEAR_PROCESS)).select(
        F.regexp_extract("process", YEAR_PROCESS, 1).alias("table_name"),
        F.regexp_extract("process", YEAR_PROCESS, 3).alias("step"),
        F.coalesce(F.col("time"), F.lit(0.0)).alias("time"),
        F.when(F.col("output") != "True", F.split("output", "; ")).alias("parts"))
    parts = y.select("table_name", "step", "time",
                     F.posexplode_outer("parts").alias("pos", "kv"))
    kv = parts.select(
        "table_name", "step", "pos",
        F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col("time")).alias("time"),
        F.split_part("kv", F.lit(": "), F.lit(1)).alias("key"),
        F.split_part("kv", F.lit(": "), F.lit(2)).try_cast("long").alias("v"))
    sums = kv.groupBy("table_name", "step", "key").agg(
        F.min("pos").alias("pos"), F.sum("v").alias("total"), F.sum("time").alias("time"))
    keyed = F.when(F.col("key").isNotNull(), F.struct("pos", "key", "total"))
    out = sums.groupBy("table_name", "step").agg(
        F.bround(F.sum("time"), 2).alias("time"),
        F.concat_ws("; ", F.transform(F.array_sort(F.collect_list(keyed)),
                                      lambda s: F.concat(s["key"], F.lit(": "), s["total"].cast("string"))))
        .alias("output"))
    return out.select("table_name", F.concat("table_name", F.lit("_"), "step").alias("process"), "time",
                      F.when(F.col("output") == "", F.lit("True")).otherwise(F.col("output")).alias("output"))


def format_output(metrics: dict) -> str:
    """{'Duplicate Rows': 3} -> 'Duplicate Rows: 3' (ledger text format)."""
    if not metrics:
        return "True"
    return "; ".join(f"{k}: {v}" for k, v in metrics.items())


class Ledger:
    """Append-only ledger stored as parquet under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return self.spark.createDataFrame([], LEDGER_SCHEMA)  # no ledger written yet

    def latest(self) -> DataFrame:
        """Current state per process: its most recent row."""
        r = self.rows()
        return r.groupBy("process").agg(
            F.max_by(F.struct("time", "output", "recorded_at"), "recorded_at").alias("s")) \
            .select("process", "s.time", "s.output", "s.recorded_at")

    def done(self, process: str) -> bool:
        hit = self.latest().where((F.col("process") == process) & F.col("time").isNotNull()).limit(1)
        return bool(hit.collect())

    def record(self, process: str, seconds: float | None, output: str) -> None:
        self.record_many([(process, seconds, output)])

    def record_many(self, rows: list[tuple[str, float | None, str]]) -> None:
        """Append several (process, time, output) rows in one small write."""
        df = self.spark.createDataFrame(rows, "process string, time double, output string")
        df.withColumn("recorded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)

    def pending(self, processes: list[str]) -> DataFrame:
        """Steps without a recorded time (anti join of the step list)."""
        steps = self.spark.createDataFrame([(p,) for p in processes], "process string")
        finished = self.latest().where(F.col("time").isNotNull()).select("process")
        return steps.join(finished, "process", "left_anti")


@dataclass
class StepResult:
    df: DataFrame
    metrics: dict
    changed: bool


Step = Callable[[DataFrame], StepResult]


def run_steps(df: DataFrame, steps: list[tuple[Step, str]], ledger: Ledger,
              write: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run ``(step, process_name)`` pairs in order.

    Each step returns the new frame, its metrics and whether it changed the
    data. Steps with a recorded time at the front of the list are skipped:
    ``df`` is the table they have written. From the first pending step on all
    run, for a later step's record says nothing about data that lacks an
    earlier step. When any step changed the data and ``write`` is given, the
    result is written once (to a new path, never over the input) and the
    written table is returned, which also cuts the lineage. The ledger rows
    follow the data: a run that stops before has recorded nothing.
    """
    changed, rows, begun = False, [], False
    for step, name in steps:
        if not begun and ledger.done(name):
            continue
        begun = True
        t0 = _time.time()
        res = step(df)
        rows.append((name, round(_time.time() - t0, 2), format_output(res.metrics)))
        df, changed = res.df, changed or res.changed
    if changed and write is not None:
        df = write(df)
    if rows:
        ledger.record_many(rows)
    return df
