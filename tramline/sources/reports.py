"""Sectioned text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.ordering import carry_forward


def read_report_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line) of text files, read line by line in as many splits as
    the files have, so a report of any size is dealt to many tasks. ``pos`` is
    (part, block, row): the order of the lines in their report, to sort by.

    The part files below a folder ``file=<value>`` (see ``write_report``) are
    one report, in the order of their names; any other file is its own."""
    raw = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__row"))
    folder = F.regexp_extract("__path", "^(.*/file=[^/]*)/[^/]*$", 1)
    # the lines of one block come in order, in one task
    return raw.select(F.when(folder != "", folder).otherwise(F.col("__path")).alias("file"),
                      F.struct(F.element_at(F.split("__path", "/"), -1).alias("part"), F.col("__block").alias("block"),
                               F.col("__row").alias("row")).alias("pos"), "line")


def parse_sectioned_report(lines: DataFrame, file_cols: list[str], pos_col: str,
                           line_col: str) -> DataFrame:
    """'Year: y' headers followed by 'key: value' lines -> (year, column_name,
    count). The header is carried forward over the lines of its file; lines
    whose value is not an integer (e.g. a time) are skipped."""
    t = F.trim(F.col(line_col))
    header = F.when(t.contains("Year:"), F.split_part(t, F.lit(": "), F.lit(2)).try_cast("int"))
    df = lines.withColumn("__hdr", header)
    df = carry_forward(df, file_cols, pos_col, "__hdr", "year")
    kv = df.where(F.col("__hdr").isNull() & ~t.contains("Year:") & t.contains(": ")).select(
        "year",
        F.trim(F.split_part(t, F.lit(": "), F.lit(1))).alias("column_name"),
        F.trim(F.split_part(t, F.lit(": "), F.lit(2))).try_cast("long").alias("count"))
    return kv.where(F.col("count").isNotNull() & F.col("year").isNotNull())


def render_sectioned_report(counts: DataFrame, file_col, section_col: str, key_col: str, value_col: str,
                            footer: str | None = None) -> DataFrame:
    """(file, pos, line) of a sectioned text report: per section a
    'Year: <section>' header and a separator, one '<key>: <value>' line per
    count row and an optional footer line. Rendered from one pass over the
    counts: each count row emits its section's lines; repeated headers and
    footers are one line each, equal count lines stay as many as they are."""
    sec = F.col(section_col)
    line = lambda pos, text: F.struct(pos.alias("pos"), text.alias("line"))
    parts = [line(sec * 100 + 1, F.concat(F.lit("Year: "), sec.cast("string"))),
             line(sec * 100 + 2, F.lit("-----------------------------------")),
             line(sec * 100 + 10, F.concat(F.lit("    "), F.col(key_col), F.lit(": "),
                                           F.col(value_col).cast("string")))]
    if footer is not None:
        parts.append(line(sec * 100 + 90, F.lit(footer)))
    lines = (counts.select(file_col.alias("file"), F.explode(F.array(*parts)).alias("l"))
             .groupBy("file", "l.pos", "l.line").agg(F.count(F.lit(1)).alias("n")))
    copies = F.when(F.pmod("pos", F.lit(100)) == 10, F.col("n")).otherwise(F.lit(1))
    return lines.select("file", "pos", "line", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))).alias("c")).drop("c")


def write_report(lines: DataFrame, path: str) -> None:
    """A folder ``file=<value>`` per report with its lines in ``pos`` order:
    the rows are dealt by ranges of (file, pos), so a long report becomes
    several part files, whose names follow the order of their lines."""
    (lines.repartitionByRange("file", "pos").sortWithinPartitions("file", "pos").select("file", "line")
     .write.mode("errorifexists").partitionBy("file").text(path))
