"""Joins and lookups.

Spark picks the physical join: Catalyst broadcasts a side whose bytes are
known to be small, AQE turns a shuffle join into a broadcast where the
measured size allows and splits skewed partitions. The library forces no
broadcast by counting rows and runs no job to decide on a plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_on(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Join condition with ``<=>`` per key pair (NULL keys match NULL keys,
    as pandas ``merge``/``duplicated`` treat NaN)."""
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])


def key_join(df: DataFrame, keys_df: DataFrame, on: list[tuple[str, str]], how: str) -> DataFrame:
    """Semi or anti join of ``df`` against the distinct keys of ``keys_df``;
    ``on`` = [(column of df, column of keys_df)].

    The key side is de-duplicated first (combined map-side) and keys with a
    NULL are dropped, so a NULL key of ``df`` never matches (SQL / ``isin``
    semantics) and a key repeated a billion times arrives as one row. Both
    sides join on struct-wrapped keys, which makes both inputs plain shuffle
    stages: the shape in which AQE splits the partition of a key that holds a
    large share of ``df``, or broadcasts a key side that turns out small.
    """
    names = [f"__jk{i}" for i in range(len(on))]
    keys = keys_df.select(*[F.col(r).alias(n) for (_, r), n in zip(on, names)]).dropna().distinct()
    keys = keys.select(F.struct(*[F.col(n) for n in names]).alias("__jks"))
    left = df.withColumn("__jkl", F.struct(*[F.col(l) for l, _ in on]))
    return left.join(keys, left["__jkl"] == keys["__jks"], how).drop("__jkl")


def semi(df: DataFrame, keys_df: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows whose key occurs in ``keys_df`` (``isin`` of another table)."""
    on = [on] if isinstance(on, str) else on
    return key_join(df, keys_df, [(c, c) for c in on], "left_semi")


def anti(df: DataFrame, keys_df: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows whose key does not occur in ``keys_df``; a NULL key stays."""
    on = [on] if isinstance(on, str) else on
    return key_join(df, keys_df, [(c, c) for c in on], "left_anti")


def assert_unique(df: DataFrame, keys: list[str], what: str = "lookup") -> None:
    """Raise if a key occurs twice (a lookup must match at most one row).

    One aggregation; only a single offending key is fetched.
    """
    dup = (df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"{what}: key {dup[0].asDict()} is not unique")


def lookup_fill(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                fill: dict[str, str], check_unique: bool = True) -> DataFrame:
    """Left lookup by key (J7): for each child row with a matching parent,
    set ``child[c] = parent[p]`` for ``fill = {c: p}``; other rows keep their
    value. The parent key must be unique."""
    if check_unique:
        assert_unique(parent, [parent_key], "lookup table")
    cols = {p: f"__lk_{i}" for i, p in enumerate(fill.values())}
    right = parent.select(F.col(parent_key).alias("__lk_key"),
                          *[F.col(p).alias(a) for p, a in cols.items()])
    joined = child.join(right, child[child_key] == right["__lk_key"], "left")
    matched = F.col("__lk_key").isNotNull()
    for c, p in fill.items():
        src = F.col(cols[p])
        if c in child.columns:
            joined = joined.withColumn(c, F.when(matched, src).otherwise(F.col(c)))
        else:
            joined = joined.withColumn(c, src)
    return joined.drop("__lk_key", *cols.values())


def fill_from_parent(child: DataFrame, parent: DataFrame, fk: str, pk: str,
                     fill: dict[str, str], when_null: str,
                     flag_col: str | None = None, flag_value=None, check_unique: bool = True) -> DataFrame:
    """Foreign-key fill (J8): where ``child[when_null]`` is NULL and the parent
    exists, copy ``fill = {child_col: parent_col}`` and set ``flag_col`` to
    ``flag_value``, even if the parent's own values are NULL. The parent key
    must be unique (checked), so no child row is multiplied."""
    if check_unique:
        assert_unique(parent, [pk], "parent table")
    cols = {p: f"__fp_{i}" for i, p in enumerate(fill.values())}
    right = parent.select(F.col(pk).alias("__fp_key"),
                          *[F.col(p).alias(a) for p, a in cols.items()])
    joined = child.join(right, child[fk] == right["__fp_key"], "left")
    # Decide once, before any of the columns the test reads is overwritten.
    joined = joined.withColumn("__fp_hit", F.col(when_null).isNull() & F.col("__fp_key").isNotNull())
    hit = F.col("__fp_hit")
    if flag_col is not None:
        joined = joined.withColumn(flag_col, F.when(hit, F.lit(flag_value)).otherwise(F.col(flag_col)))
    for c, p in fill.items():
        joined = joined.withColumn(c, F.when(hit, F.col(cols[p])).otherwise(F.col(c)))
    return joined.drop("__fp_key", "__fp_hit", *cols.values())


def combine_counts(a: DataFrame, b: DataFrame, key: str, a_name: str, b_name: str) -> DataFrame:
    """Full outer combination of two (key, count) tables; missing -> 0."""
    left = a.select(F.col(key), F.col("count").alias(a_name))
    right = b.select(F.col(key), F.col("count").alias(b_name))
    return (left.join(right, on=key, how="full_outer")
            .select(key, F.coalesce(F.col(a_name), F.lit(0)).alias(a_name),
                    F.coalesce(F.col(b_name), F.lit(0)).alias(b_name)))


def composite_consistency(triples: DataFrame, reference: DataFrame, key: str,
                          compare: list[str]) -> DataFrame:
    """Distinct key tuples checked against a dictionary keyed by ``key``.

    Returns one row per distinct tuple with ``consistent`` = every compared
    column is null-safe equal to the dictionary's value (a missing key is
    inconsistent); any number of columns is compared per key.
    """
    t = triples.select(key, *compare).distinct()
    r = reference.select(F.col(key).alias("__ck"), *[F.col(c).alias(f"__r_{c}") for c in compare])
    j = t.join(r, t[key] == r["__ck"], "left")
    ok = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in compare])
    return j.select(key, *compare, (F.col("__ck").isNotNull() & ok).alias("consistent"))
