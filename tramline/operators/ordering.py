"""Ordering without a single-task window.

A window with no partition (``row_number().over(orderBy(x))``) moves all rows
into one task. Here row numbers come from a range-partitioned sort instead:
per-partition counts become offsets and each row's position inside its
partition is added, so every step is distributed and only one count per
partition reaches the driver.

Group attributes (size, maximum, first row) are computed by a partial
aggregation and joined back, so a key holding a third of all rows is
combined map-side and the join back can be split by AQE's skew handling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def with_row_number(df: DataFrame, order_cols: list[str], name: str = "row_id",
                    start: int = 1, n_partitions: int | None = None) -> DataFrame:
    """Consecutive numbers ``start, start+1, ...`` in ascending order of
    ``order_cols`` (NULLs first), without a single-partition window (W4, P8).

    1. Range-partition and sort within partitions (Spark's range partitioner
       samples the keys and finds each row's partition by binary search, for
       any number of partitions).
    2. Tag rows with their partition and ``monotonically_increasing_id``
       (partition << 33 | position) and write that as parquet below the
       shared checkpoint folder, so both following passes see identical tags
       and the lineage is cut.
    3. Count rows per partition (one small aggregate) -> prefix offsets, a
       table with one row per partition.
    4. row id = offset of the partition + position + start: a broadcast
       join with the offsets, no shuffle of the rows.

    The order columns should identify rows; ties get an arbitrary order, as
    in any sort.
    """
    tagged = sorted_tags(df, order_cols, n_partitions)
    off = partition_offsets(tagged, F.count(F.lit(1)))
    position = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    rid = F.col("__off") + position + F.lit(start)
    return (tagged.join(F.broadcast(off), "__pid").withColumn(name, rid.cast("long"))
            .drop("__pid", "__mid", "__off"))


def sorted_tags(df: DataFrame, order_cols: list[str], n_partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order_cols`` (NULLs first),
    with its partition ``__pid`` and running id ``__mid``, written as parquet
    below the shared checkpoint folder: all later passes see the same tags."""
    from tramline.session import materialize
    n = n_partitions or _shuffle_partitions(df)
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    return materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                       .select("*", F.spark_partition_id().alias("__pid"),
                               F.monotonically_increasing_id().alias("__mid")), "row-numbers")


def partition_offsets(tagged: DataFrame, weight: Column) -> DataFrame:
    """(__pid, __off): the sum of ``weight`` (an aggregate) over all earlier
    partitions. One row per partition, a number known up front, so the table
    may pass the driver and be broadcast."""
    counts = sorted((r[0], r[1]) for r in tagged.groupBy("__pid").agg(weight).collect())
    offsets, running = [], 0
    for pid, cnt in counts:
        offsets.append((pid, running))
        running += cnt
    return tagged.sparkSession.createDataFrame(offsets, "__pid int, __off long")


def running_total(df: DataFrame, order_cols: list[str], weight: str, name: str = "running",
                  n_partitions: int | None = None) -> DataFrame:
    """Sum of ``weight`` over the rows before each row in the order of
    ``order_cols``, without a single-partition window: sums inside the range
    partitions plus the partitions' offsets."""
    tagged = sorted_tags(df, order_cols, n_partitions)
    off = partition_offsets(tagged, F.sum(weight))
    inside = Window.partitionBy("__pid").orderBy("__mid").rowsBetween(Window.unboundedPreceding, -1)
    return (tagged.withColumn(name, F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .join(F.broadcast(off), "__pid").withColumn(name, (F.col(name) + F.col("__off")).cast("long"))
            .drop("__pid", "__mid", "__off"))


def page(df: DataFrame, order_cols: list[str], page_no: int, size: int = 10) -> DataFrame:
    """Rows of page ``page_no`` (1-based) in the order of ``order_cols``
    (F11). Planned as a distributed top-(page*size) plus an offset."""
    ordered = df.orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
    return ordered.offset((page_no - 1) * size).limit(size)


def head(df: DataFrame, order_cols: list[str], n: int = 10) -> DataFrame:
    return page(df, order_cols, 1, n)


def tail(df: DataFrame, order_cols: list[str], n: int = 10) -> DataFrame:
    """Last ``n`` rows, returned in ascending order."""
    last = df.orderBy(*[F.col(c).desc_nulls_last() for c in order_cols]).limit(n)
    return last.orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``__k = struct(keys)``. Struct equality treats NULL fields as equal
    (pandas semantics for NaN keys)."""
    return df.withColumn("__k", F.struct(*[F.col(k) for k in keys]))


def _join_back(kd: DataFrame, g: DataFrame, keys: list[str]) -> DataFrame:
    """Join per-key results ``g`` (keyed by ``__k``) back onto the rows.

    The per-key side is re-keyed with a rebuilt struct, so it is shuffled
    once more (one row per key, cheap) instead of reusing the aggregation's
    partitioning: then both join inputs are plain shuffle stages and AQE's
    skew-join handling can split the partition of a key that holds a large
    share of the rows (it cannot split a join fed by an aggregate).
    """
    gk = g.select(F.struct(*[F.col(f"__k.{k}").alias(k) for k in keys]).alias("__gk"),
                  *[c for c in g.columns if c != "__k"])
    return kd.join(gk, kd["__k"] == gk["__gk"], "inner").drop("__k", "__gk")


def attach_group_size(df: DataFrame, keys: list[str], name: str = "group_size") -> DataFrame:
    """Each row with the number of rows sharing its key (W2). NULL keys form
    one group, like pandas ``duplicated``."""
    kd = _keyed(df, keys)
    return _join_back(kd, kd.groupBy("__k").agg(F.count(F.lit(1)).alias(name)), keys)


def attach_group_agg(df: DataFrame, keys: list[str], agg: Column, name: str, min_rows: int = 1) -> DataFrame:
    """Each row with a per-group aggregate such as ``max(c)`` (W1), rows of
    groups of at least ``min_rows`` rows only."""
    kd = _keyed(df, keys)
    g = kd.groupBy("__k").agg(agg.alias(name), *([F.count(F.lit(1)).alias("__rows")] if min_rows > 1 else []))
    if min_rows > 1:
        g = g.where(F.col("__rows") >= min_rows).drop("__rows")
    return _join_back(kd, g, keys)


def flag_repeats(df: DataFrame, keys: list[str], order_cols: list[str],
                 name: str = "is_repeat") -> DataFrame:
    """Mark rows after the first of their key group, first = smallest
    ``order_cols`` (W3, pandas ``duplicated(keep='first')``).

    Exactly one row of each key is its first. Ties in ``order_cols`` are
    broken by the other columns; rows equal in all columns are counted, and
    one of their copies is the first. Equal rows travel as one row with a
    count, and the group minimum is a partial (map-side) aggregation, so a key
    holding a third of all rows is reduced to one row per task before the
    shuffle.
    """
    o = F.struct(*[F.col(c) for c in [*order_cols, *[c for c in df.columns if c not in order_cols]]])
    kd = _keyed(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies")), keys)
    j = _join_back(kd, kd.groupBy("__k").agg(F.min(o).alias("__first")), keys)
    copy = j.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return copy.select(*df.columns, (~(o.eqNullSafe(F.col("__first")) & (F.col("__copy") == 1))).alias(name))


def carry_forward(df: DataFrame, partition_cols: list[str], order_col: str, value: str,
                  name: str, n_partitions: int | None = None) -> DataFrame:
    """Last non-null ``value`` up to each row (W5), per group (e.g. per report
    file), as a prefix scan: a group of any size is dealt to many tasks.

    1. Range-partition and sort by (group, order); partitions are written once.
    2. One row per (partition, group) with its last value; over these few rows
       a window finds what each partition takes over from the earlier ones.
    3. Inside a partition, a window over its own rows, bounded by the
       partition's size; rows before its first value get what is taken over.
    """
    tagged = sorted_tags(df, [*partition_cols, order_col], n_partitions)
    tagged = tagged.withColumn("__g", F.struct(*[F.col(c) for c in partition_cols]) if partition_cols else F.lit(0))
    last = tagged.groupBy("__pid", "__g").agg(F.max(F.when(F.col(value).isNotNull(), F.struct("__mid", F.col(value).alias("v")))).alias("l"))
    earlier = Window.partitionBy("__g").orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    taken = last.select(F.col("__pid").alias("__p"), F.col("__g").alias("__h"),
                        F.last(F.col("l.v"), ignorenulls=True).over(earlier).alias("__taken"))
    inside = Window.partitionBy("__pid", "__g").orderBy("__mid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = tagged.withColumn("__own", F.last(F.col(value), ignorenulls=True).over(inside))
    j = own.join(taken, (F.col("__pid") == F.col("__p")) & F.col("__g").eqNullSafe(F.col("__h")))
    return j.select(*df.columns, F.coalesce("__own", "__taken").alias(name))


def top_k_by(df: DataFrame, measure: str, k: int, tiebreak: list[str],
             descending: bool = True) -> DataFrame:
    """The ``k`` rows with the largest (or smallest) ``measure``, ties broken
    by ``tiebreak`` ascending (T2). Planned as TakeOrdered: each partition
    keeps its own top k, so the driver never sees more than k per task."""
    m = F.col(measure).desc_nulls_last() if descending else F.col(measure).asc_nulls_last()
    return df.orderBy(m, *[F.col(c).asc_nulls_last() for c in tiebreak]).limit(k)


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)
