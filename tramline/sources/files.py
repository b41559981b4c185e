"""File scans.

CSV files are read with an explicit schema (no inference pass), many files in
one scan, and only the selected columns are parsed.
"""

from __future__ import annotations

from hashlib import sha256
from heapq import nsmallest
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.dates import dates_from_file_name
from tramline.functions.numbers import decimal_comma_to_double
from tramline.operators.projection import conform


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType | str | None = None,
             sep: str = ",", header: bool = True, columns: list[str] | None = None,
             glob_filter: str | None = None, rescue: str | None = None) -> DataFrame:
    """One scan over one path, a glob, a directory of part files or a list of
    them (S1, S2, S5, S6). A cell that does not fit the schema becomes NULL
    and never fails the job.

    With ``rescue``, nothing is lost that way: the cells are read as text and
    cast by ``operators.projection.conform``, and the column ``rescue`` holds
    every cell that did not fit, with its text, and the raw line of a record
    with too few or too many fields (column_name NULL). See
    ``rejected_cells`` and ``reject_observation`` for lists and counts.
    Pruned ``columns`` are not parsed and so never rescued."""
    r = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if glob_filter:
        r = r.option("pathGlobFilter", glob_filter)
    if rescue is None:
        if schema is not None:
            r = r.schema(schema)
        df = r.csv(paths)
        return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df
    if schema is None:
        raise ValueError("rescued cells need a declared schema")
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in declared.fields]
                       + [T.StructField("__record", T.StringType())])
    df = r.schema(raw).option("columnNameOfCorruptRecord", "__record").csv(paths)
    wanted = T.StructType([f for f in declared.fields if columns is None or f.name in columns])
    return conform(df, wanted, rescue=rescue, record="__record")


def rejected_cells(df: DataFrame, rescue: str, keep: list[str] | None = None) -> DataFrame:
    """The side output of a rescue column: one row per cell that did not fit
    (column_name, value; column_name NULL: a whole record of another width)."""
    return df.select(*(keep or []), F.explode(F.col(f"`{rescue}`")).alias("__x")).select(*(keep or []), "__x.column_name", "__x.value")


def rejected_counts(df: DataFrame, rescue: str) -> DataFrame:
    """(column_name, rejected): cells that did not fit, per column."""
    return rejected_cells(df, rescue).groupBy("column_name").agg(F.count(F.lit(1)).alias("rejected"))


def reject_observation(df: DataFrame, rescue: str, name: str = "rejects") -> tuple[DataFrame, Observation]:
    """``df`` with an observation that counts rows, rows with a rejected cell
    and rejected cells while some action runs over it: no pass of its own."""
    seen = Observation(name)
    cells = F.size(F.col(f"`{rescue}`"))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(cells > 0).alias("rows_rejected"),
                      F.coalesce(F.sum(cells), F.lit(0)).alias("cells_rejected")), seen


def header_columns(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names from the header line only (S7), without a byte order mark
    and quotes."""
    first = spark.read.text(path).limit(1).collect()
    return _header_cells(first[0]["value"], sep) if first else []


def _header_cells(line: str, sep: str) -> list[str]:
    return [c.strip().strip('"') for c in line.lstrip("\ufeff").split(sep)]


def pick_separator(spark: SparkSession, path: str, expected: list[str],
                   candidates: tuple[str, ...] = (",", ";")) -> str:
    """The separator whose split of the header line gives the expected
    columns (S3). Unlike a parse-error fallback, a ';' file that would parse
    as one ','-column is recognised."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return candidates[0]
    best, score = candidates[0], -1
    for sep in candidates:
        hit = len(set(_header_cells(first[0]["value"], sep)) & set(expected))
        if hit > score:
            best, score = sep, hit
    return best


def with_decimal_comma(df: DataFrame, columns: list[str]) -> DataFrame:
    """'46,95' -> 46.95 for text columns written with a decimal comma."""
    for c in columns:
        df = df.withColumn(c, decimal_comma_to_double(F.col(c)))
    return df


def file_week_dates(df: DataFrame) -> DataFrame:
    """Add the source file name and the week it covers, read from names like
    'X_20220102_20220108.csv' (S8)."""
    name = F.col("_metadata.file_name")
    start, end = dates_from_file_name(name)
    return df.select("*", name.alias("file_name"), start.alias("week_start"), end.alias("week_end"))


def _paths(spark: SparkSession, directory: str, glob_filter: str) -> list[str]:
    """All files of a directory tree that match a name pattern, empty ones
    included: Spark's own listing of the directory, which its driver holds for
    any scan; no file is opened."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob_filter).option("recursiveFileLookup", True).load(directory)
    return [unquote(p) for p in r.inputFiles()]


def list_files(spark: SparkSession, directory: str, glob_filter: str = "*.csv") -> DataFrame:
    """Distinct files of a directory matching a name pattern, with their week
    dates (S8), empty files included."""
    names = sorted({p.rsplit("/", 1)[-1] for p in _paths(spark, directory, glob_filter)})
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    start, end = dates_from_file_name(F.col("file_name"))
    return df.select("file_name", start.alias("week_start"), end.alias("week_end"))


def random_files(spark: SparkSession, directory: str, n: int, seed: int = 0, glob_filter: str = "*.csv") -> list[str]:
    """``n`` files of a directory tree, drawn by a hash of seed and name below
    the directory (F12): the same files for the same seed and listing, in
    whatever order they are listed; all of them if there are fewer. Read them
    with ``read_csv(spark, random_files(...))``."""
    base = directory.rstrip("/")
    rank = lambda p: sha256(f"{seed}:{p.rsplit(base, 1)[-1]}".encode()).digest()
    return sorted(nsmallest(n, _paths(spark, directory, glob_filter), key=rank))
