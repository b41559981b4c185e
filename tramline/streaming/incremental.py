"""Clean newly arrived CSV files incrementally.

A file-source stream with ``trigger(availableNow=True)``: each run picks up
the files that arrived since the previous run (the checkpoint remembers the
processed files, in the shared checkpoint folder), cleans them with column
expressions, and in ``foreachBatch``

* writes the batch to ``<out>/batch_id=<n>`` with overwrite, so a replayed
  batch after a failure replaces its own output instead of duplicating it;
* gathers the batch metrics with an ``Observation`` during that same write
  (no second pass) and appends one ledger row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.dates import parse_dmy
from tramline.functions.nulls import unify_empty
from tramline.sources.ledger import Ledger, format_output


def cleaned_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sep: str = ",",
                   date_cols: list[str] | None = None, glob: str = "*.csv",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of the cleaned rows of newly arrived files: text
    sentinels unified to NULL, 'dd.mm.yy' dates parsed (kept as text in
    ``<col>_text`` to count lost dates), and the source file name."""
    r = (spark.readStream.schema(schema).option("header", True).option("sep", sep)
         .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(source_dir).select("*", F.col("_metadata.file_name").alias("file_name"))
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            df = df.withColumn(f.name, unify_empty(F.col(f.name)))
    for c in date_cols or []:
        df = df.withColumn(f"{c}_text", F.col(c)).withColumn(c, parse_dmy(F.col(c)))
    return df


def clean_new_files(spark: SparkSession, source_dir: str, schema: T.StructType, out_path: str,
                    ledger_path: str, process: str, sep: str = ",", date_cols: list[str] | None = None,
                    glob: str = "*.csv", *, checkpoint: str) -> None:
    """Process every file that arrived since the last call, then stop.
    ``checkpoint`` remembers the files seen and the batch number: always the
    same shared folder, or old files are read again."""
    date_cols = date_cols or []
    stream = cleaned_stream(spark, source_dir, schema, sep, date_cols, glob)
    ledger = Ledger(spark, ledger_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        obs = Observation(f"{process}_{batch_id}")
        lost = [F.count_if(F.col(f"{c}_text").isNotNull() & F.col(c).isNull()) for c in date_cols]
        metrics = [F.count(F.lit(1)).alias("Rows")]
        if lost:
            metrics.append(sum(lost, F.lit(0)).alias("False Dates"))
        observed = batch.observe(obs, *metrics).drop(*[f"{c}_text" for c in date_cols])
        observed.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
        ledger.record(f"{process}_Batch_{batch_id}", None, format_output(obs.get))

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
