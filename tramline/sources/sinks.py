"""Sinks (S9-S12).

A result is never written over the path it is read from (Spark refuses, and
the source files are lost); each write goes to a new versioned path.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators.projection import conform


def version_stamp() -> str:
    """Sortable version label with milliseconds, e.g. '20240102T030405123'."""
    now = time.time()
    return time.strftime("%Y%m%dT%H%M%S", time.gmtime(now)) + f"{int(now * 1000) % 1000:03d}"


def versioned_path(base: str, name: str, version: str | None = None) -> str:
    return f"{base.rstrip('/')}/{name}/v={version or version_stamp()}"


def write_versioned(df: DataFrame, base: str, name: str, fmt: str = "parquet",
                    partition_by: list[str] | None = None, version: str | None = None) -> str:
    """Multi-part write to a fresh version folder (S9); returns the path."""
    path = versioned_path(base, name, version)
    w = df.write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: str, fmt: str = "parquet") -> None:
    """Re-file rows into one folder per value of ``by`` (Q2): rows whose date
    belongs to another year land in that year's folder, new years create new
    folders. Rows are rebalanced by the partition value, so that a task writes
    few values and a value that holds much of the data is dealt to many tasks."""
    df.hint("rebalance", F.col(by)).write.mode("errorifexists").format(fmt).partitionBy(by).save(path)


def write_single_file(df: DataFrame, path: str, fmt: str = "csv", order_by: list[str] | None = None) -> str:
    """One output file (S10) of a line format (csv, json, text) in the folder
    ``path``; returns the file's path.

    All tasks write their rows as part files beside the target; at commit the
    parts' bytes are joined in order of their names. Where the file system can
    concatenate (HDFS), no byte is copied; elsewhere one stream copies them.
    So rows are computed, sorted and formatted in parallel, whatever the size.
    The folder appears by one rename, and never over an existing one."""
    if fmt not in ("csv", "json", "text"):
        raise ValueError(f"{fmt} files cannot be joined by their bytes")
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    at = jvm.org.apache.hadoop.fs.Path
    base, stamp = path.rstrip("/"), version_stamp()
    target, folder, staged = at(base), at(f"{base}.parts-{stamp}"), at(f"{base}.joined-{stamp}")
    fs = target.getFileSystem(conf)
    if fs.exists(target):
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path {path} already exists.")
    rows = df.orderBy(*order_by) if order_by else df
    rows.write.mode("errorifexists").format(fmt).save(folder.toString())
    parts = sorted((f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-") and f.getLen() > 0),
                   key=lambda p: p.getName())
    joined = at(staged, f"data.{'txt' if fmt == 'text' else fmt}")
    out = fs.create(joined, False)
    try:
        if fmt == "csv":
            out.write(bytearray(",".join(_csv_cell(c) for c in df.columns) + "\n", "utf-8"))
        if not _can_concat(fs):
            for part in parts:
                source = fs.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
                finally:
                    source.close()
    finally:
        out.close()
    if _can_concat(fs) and parts:
        array = spark.sparkContext._gateway.new_array(at, len(parts))
        for i, part in enumerate(parts):
            array[i] = part
        fs.concat(joined, array)
    if not fs.rename(staged, target):
        raise OSError(f"cannot move the joined file to {path}")
    fs.delete(folder, True)
    return f"{base}/{joined.getName()}"


def _can_concat(fs) -> bool:
    return fs.getScheme() == "hdfs"


def _csv_cell(text: str) -> str:
    if any(c in text for c in ',"\n\r') or text != text.strip():
        return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'
    return text


def save_table(df: DataFrame, name: str, mode: str = "errorifexists") -> None:
    """Table sink with replace / append / fail."""
    modes = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
    df.write.mode(modes.get(mode, mode)).saveAsTable(name)


def save_typed_table(df: DataFrame, name: str, schema: T.StructType, mode: str = "fail") -> None:
    """Create a table with declared types (S12): cast to the schema, NaN in
    float columns -> NULL, then write."""
    typed = conform(df, schema)
    for f in schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            typed = typed.withColumn(f.name, F.when(F.isnan(f.name), None).otherwise(F.col(f.name)))
    save_table(typed, name, mode)


def read_latest(spark, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """The newest version written by ``write_versioned`` (the 'switch' to a
    new version is simply that readers take the largest ``v``). ``v`` is a
    partition column, so the final filter prunes to that version's files."""
    df = spark.read.format(fmt).load(f"{base.rstrip('/')}/{name}")
    latest = df.select("v").distinct().agg(F.max("v")).first()[0]
    return df.where(F.col("v") == F.lit(latest)).drop("v")
