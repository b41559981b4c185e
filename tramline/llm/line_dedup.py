"""Line de-duplication by overlapping windows of consecutive lines.

Every run of three consecutive lines is hashed (128 bits). A window that
occurs at several places of the corpus is kept where it comes first, in the
order (document id, line number); at every later place its three lines are
covered. The covered positions of a document are merged and its covered lines
removed. DataFrame functions only, no Python on the executors.

Plan: the windows are aggregated per hash with a map-side partial minimum (a
hot window arrives as one row per task), and joined back to the occurrences
as two plain shuffles, which AQE can split where a window is hot. The texts
are shuffled once, to meet their covered positions.

Defined results: a null text stays null and an empty text stays empty; texts
of fewer lines than the window have none and stay; windows of blank lines
only are ignored; rows that share an id count as one document, so equal rows
get equal texts; null ids come before all others; an empty table gives an
empty table. Ids are whole numbers, for they order the documents: an id of
another type that is no number fails the run under ANSI rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import packed, unpacked

WINDOW = 3
#: Places are ordered by id * PLACE + line number, as one decimal, so that the
#: minimum is a hash aggregation over a fixed-width value.
PLACE = 2 ** 31
BEFORE_ALL_IDS = str(-(2 ** 63) - 1)


def _windows(lines: Column, window: int) -> Column:
    """Array of (pos, key) of all windows that hold a non-blank line."""
    def one(i: Column) -> Column:
        part = [lines[i + k] for k in range(window)]
        key = F.struct(F.xxhash64(*part).alias("a"), F.xxhash64(F.lit("second"), *part[::-1]).alias("b"))
        return F.struct(i.alias("pos"), key.alias("key"), (F.trim(F.concat(*part)) != "").alias("solid"))

    starts = F.when(F.size(lines) >= window, F.sequence(F.lit(0), F.size(lines) - window))
    return F.filter(F.transform(starts, one), lambda w: w["solid"])


def _flags(starts: Column, n_lines: Column, window: int) -> Column:
    """One '0' (kept) or '1' (covered) per line from the sorted start
    positions of covered windows: gaps and overlaps are merged piecewise."""
    before = F.concat(F.array(F.lit(-window)), starts)
    pieces = F.zip_with(starts, F.slice(before, 1, F.size(starts)), lambda s, p: F.concat(
        F.repeat(F.lit("0"), F.greatest(s - p - window, F.lit(0))),
        F.repeat(F.lit("1"), F.least(s - p, F.lit(window)))))
    rest = F.repeat(F.lit("0"), n_lines - F.element_at(starts, -1) - window)
    return F.split(F.concat(F.array_join(pieces, ""), rest), "")


def covered_starts(base: DataFrame, window: int) -> DataFrame:
    """(doc, starts): per document the sorted start positions of the windows
    that occur earlier in the corpus. ``base`` holds id, h and lines."""
    place = (F.coalesce(F.col("id").cast("decimal(20,0)"), F.lit(BEFORE_ALL_IDS).cast("decimal(20,0)"))
             * F.lit(PLACE).cast("decimal(10,0)") + F.col("w.pos").cast("decimal(10,0)"))
    places = (base.select("id", "h", F.explode(_windows(F.col("lines"), window)).alias("w"))
              .select(F.struct("id", "h").alias("doc"), F.col("w.pos").alias("pos"),
                      F.col("w.key").alias("key"), place.alias("place")))
    repeated = (places.groupBy("key").agg(F.count("*").alias("n"), F.min("place").alias("first"))
                .where("n > 1").select("key", "first"))
    later = places.join(repeated, "key").where(F.col("place") > F.col("first"))
    return later.groupBy("doc").agg(F.sort_array(F.collect_set("pos")).alias("starts"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                window: int = WINDOW, report: bool = False) -> DataFrame:
    """``docs`` with the covered lines removed from the text. With ``report``:
    (id, n_lines, n_removed, text) instead of the input's columns."""
    base = packed(docs, id_col, text_col).withColumn("lines", F.split("text", "\n"))
    covered = covered_starts(base.select("id", "h", "lines"), window)
    joined = (base.withColumn("doc", F.struct("id", "h")).join(covered, "doc", "left")
              .withColumn("flags", _flags(F.col("starts"), F.size("lines"), window)))
    kept = F.filter(F.arrays_zip("lines", "flags"), lambda z: z["flags"] == "0")
    text = F.when(F.col("starts").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda z: z["lines"]), "\n"))
    if report:
        removed = F.coalesce(F.size(F.filter("flags", lambda f: f == "1")), F.lit(0))
        return joined.select(
            F.col("id").alias(id_col), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
            F.when(F.col("starts").isNull(), 0).otherwise(removed).cast("long").alias("n_removed"),
            text.alias(text_col))
    return unpacked(joined, docs.columns, **{text_col: text})


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return dedup_lines(table(spark, sf_dir, "documents"), report=True)


OP10_SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
p AS (SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS pos FROM l WHERE len(lines) >= 3),
w AS (SELECT doc_id, pos, lines[pos + 1] AS a, lines[pos + 2] AS b, lines[pos + 3] AS c FROM p),
s AS (SELECT * FROM w WHERE trim(a || b || c) <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth FROM s),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM r, (SELECT unnest(range(0, 3)) AS k) WHERE nth > 1),
e AS (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM l),
k AS (SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.pos) FILTER (WHERE gone.pos IS NULL) AS text,
             count(gone.pos) AS n_removed
      FROM e LEFT JOIN gone ON e.doc_id = gone.doc_id AND e.pos = gone.pos GROUP BY e.doc_id)
SELECT l.doc_id, CAST(coalesce(len(l.lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM l LEFT JOIN k ON l.doc_id = k.doc_id
"""
