"""Descriptive statistics with exact quantiles.

``percentile`` keeps a value -> count map per group that ends up in one task
for a global quantile; ``percentile_approx`` is not exact. Here all columns
and all their quantiles are found together, by narrowing in long form (one row
per cell: column number, value). The input is read three times at most,
whatever its size, the number of columns and of quantiles:

1. Per column: count, plain statistics and a sketch, which gives two cut
   values around each target rank.
2. Per column: how many cells lie between and on which cuts. A rank that falls
   on a cut is found; the others lie between two neighbouring cuts.
3. The cells between those cuts, as (column, value, count). They are few (a
   sketch's error share of the rows). The counted values are written, and the
   running totals over them give the value at each rank.

Every step is a grouping by column (and cut or value) with partial aggregation
per task; the driver sees one row per column and cut.
"""

from __future__ import annotations

import math
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators.ordering import running_total
from tramline.session import materialize

SKETCH_ACCURACY = 10_000
#: Counted values that may be read by the driver instead of ranked in a job.
WINDOW_ROWS = 20_000


def _cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """(i, x) for every cell that holds a number; NaN counts as missing, as in
    pandas."""
    number = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns]
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), x.alias("x")) for i, x in enumerate(number)])
    return df.select(F.explode(pairs).alias("p")).select("p.i", "p.x").where(F.col("x").isNotNull())


def _neighbours(p: float, n: int) -> tuple[int, int, float]:
    """The two 0-based ranks around the quantile ``p`` of ``n`` values, and
    how far it lies between them."""
    r = p * (n - 1)
    k = int(math.floor(r))
    return k, min(k + 1, n - 1), r - k


def quantiles_of_columns(df: DataFrame, columns: list[str], probs: list[float], stats: list[Column] | None = None,
                         window_rows: int | None = None) -> tuple[dict[str, list], dict[str, object]]:
    """Linearly interpolated quantiles (pandas / ``quantile_cont``) of several
    columns: ({column: values}, {column: row of ``stats``}). ``stats`` are
    aggregates over the column ``x`` that ride along in the first pass. A
    column without values has None throughout and no row of statistics."""
    bound = WINDOW_ROWS if window_rows is None else window_rows
    cells = _cells(df, columns)
    eps = 4.0 / SKETCH_ACCURACY
    around = sorted({min(1.0, max(0.0, p + e)) for p in probs for e in (-eps, eps)})
    heads = cells.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("x", around, SKETCH_ACCURACY).alias("cuts"),
                                   *(stats or [])).collect()
    n = {r["i"]: r["n"] for r in heads}
    cuts = {r["i"]: sorted({v + 0.0 for v in r["cuts"]}) for r in heads}
    found: dict[tuple[int, int], float] = {}
    open_: dict[tuple[int, int], tuple[int, int]] = {}          # (column, rank) -> (gap, cells before the gap)
    ranks = {(i, k) for i in n for p in probs for k in _neighbours(p, n[i])[:2]}
    if ranks:
        # a cell's place: 2 j before the j-th cut, 2 j + 1 on it
        mine = F.element_at(F.lit([cuts.get(i, []) for i in range(len(columns))]).cast("array<array<double>>"), F.col("i") + 1)
        below = F.size(F.filter(mine, lambda c: c < F.col("x")))
        place = (2 * below + F.array_contains(mine, F.col("x")).cast("int")).alias("place")
        counts = cells.select("i", place).groupBy("i", "place").agg(F.count(F.lit(1)).alias("c")).collect()
        per: dict[int, list] = {}
        for r in counts:
            per.setdefault(r["i"], []).append((r["place"], r["c"]))
        for i, rows in per.items():
            rows.sort()
            before, ends = 0, []
            for _, c in rows:
                before += c
                ends.append(before)
            for k in [k for j, k in ranks if j == i]:
                at = bisect_left(ends, k + 1)
                where = rows[at][0]
                if where % 2:
                    found[i, k] = cuts[i][where // 2]
                else:
                    open_[i, k] = (where, ends[at] - rows[at][1])
        if open_:
            gaps = {(i, g): b for (i, _), (g, b) in open_.items()}
            inside = sum(c for i, rows in per.items() for g, c in rows if (i, g) in gaps)
            wanted = F.struct(F.col("i"), F.col("place")).isin([F.struct(F.lit(i), F.lit(g)) for i, g in gaps])
            values = (cells.select("i", "x", place).where(wanted).groupBy("i", "place", "x").agg(F.count(F.lit(1)).alias("c")))
            found |= _ranked(values, open_, inside, bound)
    out = {}
    for i, name in enumerate(columns):
        if i not in n:
            out[name] = [None] * len(probs)
            continue
        near = [_neighbours(p, n[i]) for p in probs]
        out[name] = [found[i, a] + (found[i, b] - found[i, a]) * f for a, b, f in near]
    return out, {columns[r["i"]]: r[3:] for r in heads}


def _ranked(values: DataFrame, open_: dict, inside: int, bound: int) -> dict[tuple[int, int], float]:
    """The values at the ranks of ``open_``, from the counted values of their
    gaps: read in order where they are few, else by running totals."""
    if inside <= bound:
        rows = sorted((r["i"], r["place"], r["x"], r["c"]) for r in values.collect())
        found = {}
        for (i, k), (gap, before) in open_.items():
            for _, _, x, c in [r for r in rows if r[:2] == (i, gap)]:
                before += c
                if k < before:
                    found[i, k] = x
                    break
        return found
    written = materialize(values, "describe-values")
    totals = running_total(written, ["i", "place", "x"], "c", "before")
    # ``before`` counts the cells of all earlier gaps too
    starts = totals.groupBy("i", "place").agg(F.min("before").alias("start"))
    spark = values.sparkSession
    asked = spark.createDataFrame([(i, gap, k, k - before) for (i, k), (gap, before) in open_.items()],
                                  "i int, place int, k long, inner long")
    hit = (totals.join(F.broadcast(starts), ["i", "place"]).join(F.broadcast(asked), ["i", "place"])
           .where((F.col("inner") >= F.col("before") - F.col("start")) & (F.col("inner") < F.col("before") - F.col("start") + F.col("c"))))
    return {(r["i"], r["k"]): r["x"] for r in hit.select("i", "k", "x").collect()}


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """Linearly interpolated quantiles of one column."""
    return quantiles_of_columns(df, [col], probs)[0][col]


def describe(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max of one column (pandas
    ``describe``), as one row with exact quantiles."""
    return describe_columns(df, [col], digits).drop("column_name")


def describe_columns(df: DataFrame, columns: list[str] | None = None, digits: int = 4) -> DataFrame:
    """``describe`` of several columns (all numeric columns by default), long
    form: one row per column with column_name first. All columns share the
    same three passes."""
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    x = F.col("x")
    stats = [F.round(F.avg(x), digits).alias("mean"), F.round(F.stddev_samp(x), digits).alias("std"),
             F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("count")]
    values, plain = quantiles_of_columns(df, columns, [0.25, 0.5, 0.75], stats)
    rows = []
    for c in columns:
        mean, std, low, high, count = plain.get(c, (None, None, None, None, 0))
        rows.append((c, count, mean, std, low, *[None if v is None else round(v, digits) for v in values[c]], high))
    return df.sparkSession.createDataFrame(rows, "column_name string, count bigint, mean double, std double, min double, "
                                                 "p25 double, p50 double, p75 double, max double")
