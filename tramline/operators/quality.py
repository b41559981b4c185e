"""Data-quality checks.

Each check is a DataFrame plan: counts come from one aggregation, offending
rows from an anti join or a filter. Nothing is pulled to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.operators.joins import key_join
from tramline.operators.ordering import attach_group_agg, attach_group_size


# ---------------------------------------------------------------- duplicates

def dedup_exact(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Global exact de-duplication (A16/A19). The hash aggregation behind
    ``dropDuplicates`` combines copies map-side, so a value repeated a
    billion times is reduced before the shuffle."""
    return df.dropDuplicates(subset) if subset else df.distinct()


def dedup_counts(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """One row: rows before, rows after de-duplication, rows removed.

    Computed as one aggregation over the distinct groups with their sizes,
    instead of two counts of two plans.
    """
    keys = subset or df.columns
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__m"))
    return (groups.agg(F.coalesce(F.sum("__m"), F.lit(0)).cast("long").alias("rows_before"),
                       F.count(F.lit(1)).alias("rows_after"))
            .select("rows_before", "rows_after",
                    (F.col("rows_before") - F.col("rows_after")).alias("duplicates_removed")))


def duplicate_rows(df: DataFrame, subset: list[str], name: str = "group_size") -> DataFrame:
    """Every row whose key occurs more than once (A17, ``keep=False``)."""
    return attach_group_size(df, subset, name).where(F.col(name) > 1)


def repeats_after_first(df: DataFrame, subset: list[str], order_cols: list[str]) -> DataFrame:
    """Rows after the first of their key (A18, ``keep='first'``), first =
    smallest ``order_cols``, ties broken by the other columns.

    One grouping by key gives each repeated key's smallest row (combined
    map-side); joined back, rows that differ from it are repeats. Of the rows
    equal to it all but one are: they are counted per key and put out again
    that often, in portions, so a row copied a billion times stays one row
    with a count until then."""
    o = F.struct(*[F.col(c) for c in [*order_cols, *[c for c in df.columns if c not in order_cols]]])
    joined = attach_group_agg(df, subset, F.struct(F.count(F.lit(1)).alias("n"), F.min(o).alias("first")), "__g", min_rows=2)
    is_first = o.eqNullSafe(F.col("__g.first"))
    rest = joined.where(~is_first).select(*df.columns)
    copies = joined.where(is_first).groupBy(F.col("__g.first").alias("r")).agg((F.count(F.lit(1)) - 1).alias("n")).where("n > 0")
    portion = 10_000
    starts = copies.select("r", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / portion))).alias("p"))
    again = starts.select(F.explode(F.array_repeat("r", F.least(F.lit(portion), F.col("n") - F.col("p") * portion).cast("int"))).alias("r"))
    return rest.unionByName(again.select(*[F.col(f"r.{c}").alias(c) for c in df.columns]))


def same_key_counts(df: DataFrame, keys: list[str], also: list[str], not_null: list[str],
                    names=("same", "also_same")) -> DataFrame:
    """Rows sharing ``keys`` with another row, and rows that also share
    ``also`` (Q6). Rows with a NULL in ``not_null`` are dropped first; NULLs
    elsewhere compare equal (pandas ``duplicated``). Sums of the sizes of
    groups larger than one, from one pass: the groups by ``keys`` are made of
    those by ``keys`` and ``also``."""
    fine = df.dropna(subset=not_null).groupBy(*keys, *also).agg(F.count(F.lit(1)).alias("__m"))
    m = F.col("__m")
    coarse = fine.groupBy(*keys).agg(F.sum("__m").alias("__m"), F.sum(F.when(m > 1, m)).alias("__f"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return coarse.agg(total(F.when(m > 1, m)).alias(names[0]), total(F.col("__f")).alias(names[1]))


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """Place single-row results next to each other without a join: union
    them (missing columns NULL) and take each column's non-null value."""
    u = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), single_rows)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


# ---------------------------------------------------------------- row rules

def disagreement_counts(cols: list[str]) -> list[Column]:
    """Two aggregates: rows whose ``cols`` are all present but not all the
    same, and rows that miss one (A20, F5)."""
    values = F.array(*cols)
    missing = F.exists(values, lambda v: v.isNull())
    return [F.count_if(~missing & (F.size(F.array_distinct(values)) > 1)), F.count_if(missing)]


def date_disagreement(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: rows where all dates are present but not all equal, and rows
    with any missing date (A20, F5)."""
    differ, missing = disagreement_counts(cols)
    return df.agg(differ.alias("different_dates"), missing.alias("false_dates"))


def partially_filled(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: rows where some but not all of ``cols`` are empty."""
    n_empty = reduce(lambda a, b: a + b,
                     [F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), 1).otherwise(0) for c in cols])
    return df.agg(F.count_if((n_empty > 0) & (n_empty < len(cols))).alias("inconsistent_rows"))


def rule_violations(df: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(family, rule, violations, all_pass) for rule = SQL predicate that a
    valid row satisfies (Q13, A9, A10, D3). All rules are evaluated in one
    aggregation; every failing rule is reported (no early stop). A row whose
    predicate is NULL counts as a violation."""
    aggs = [F.count_if(~F.coalesce(F.expr(pred), F.lit(False))).alias(f"r{i}")
            for i, (_, _, pred) in enumerate(rules)]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(fam).alias("family"), F.lit(name).alias("rule"),
                     F.col(f"r{i}").alias("violations"))
            for i, (fam, name, _) in enumerate(rules)]
    return (wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")
            .withColumn("all_pass", F.col("violations") == 0))


# ---------------------------------------------------------------- foreign keys

def orphan_rows(child: DataFrame, checks: list[tuple], keep: list[str] | None = None,
                period: Column | None = None) -> DataFrame:
    """Rows whose foreign key has no parent (Q1, J6), one output row per
    failing (row, side): a row failing both sides appears twice, as in the
    original sum of both sides; a NULL key has no parent. ``checks`` =
    (side, parent, child_key(s), parent_key(s)); ``keep`` = child columns to
    return (all when None). Child rows are otherwise unchanged.

    The child is read once: each row gives a (side, key) pair per side, and
    one anti join against the distinct (side, key) pairs of all parents leaves
    the failing ones. Catalyst and AQE choose the join: small parents are
    broadcast, hot keys of the child are split.
    """
    norm = []
    for side, parent, ck, pk in checks:
        norm.append((side, parent, [ck] if isinstance(ck, str) else list(ck), [pk] if isinstance(pk, str) else list(pk)))
    keep_cols = keep or child.columns
    extra = [period.alias("period")] if period is not None else []
    # fk_value keeps the key type when every side has one key of the same
    # type; otherwise (composite or mixed keys) it is the key as text.
    types = {child.schema[ck[0]].dataType.simpleString() if len(ck) == 1 else None for _, _, ck, _ in norm}
    fk_type = types.pop() if len(types) == 1 and None not in types else None

    def key(columns: list[Column], kinds) -> Column:
        typed = [c.cast(t) for c, t in zip(columns, kinds, strict=True)]
        if fk_type:
            return typed[0]
        whole = reduce(lambda a, b: a & b, [c.isNotNull() for c in typed])
        return F.when(whole, F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(typed)])))

    sides, known = [], []
    for side, parent, ck, pk in norm:
        kinds = [child.schema[c].dataType for c in ck]
        shown = F.col(ck[0]) if len(ck) == 1 else F.struct(*[F.col(c) for c in ck])
        sides.append(F.struct(F.lit(side).alias("side"), shown.cast(fk_type or "string").alias("fk_value"),
                              key([F.col(c) for c in ck], kinds).alias("__key")))
        known.append(parent.select(F.lit(side).alias("side"), key([F.col(c) for c in pk], kinds).alias("__key")))
    pairs = child.select(*keep_cols, *extra, F.explode(F.array(*sides)).alias("__f")).select(
        *keep_cols, *(["period"] if extra else []), "__f.*")
    return key_join(pairs, reduce(DataFrame.unionByName, known), [("side", "side"), ("__key", "__key")], "left_anti").drop("__key")


def orphan_counts(orphans: DataFrame, by: list[str]) -> DataFrame:
    return orphans.groupBy(*by).agg(F.count(F.lit(1)).alias("orphans"))


def orphans_reappear(orphans: DataFrame, parents: DataFrame, key: list[str], period: str = "period") -> DataFrame:
    """Per period: distinct orphan keys of all sides and how many of them
    stand in the parent table of a later period (Q17, U3, U4). ``parents``
    holds ``key`` and ``period``; a parent's last period decides, so there is
    no intersection per pair of periods. Orphans with a null key part count
    as one key that never reappears."""
    last = parents.groupBy(*key).agg(F.max(period).alias("__last"))
    j = orphans.select(*key, period).distinct().join(last, key, "left")
    return j.groupBy(period).agg(F.count(F.lit(1)).alias("orphan_keys"),
                                 F.count_if(F.col("__last") > F.col(period)).alias("reappear_later"))


# ---------------------------------------------------------------- copies vs parents

def mismatch_rows(joined: DataFrame, pairs: list[tuple[str, str, str]], keep: list[str]) -> DataFrame:
    """Rows where any copied column differs from its parent column (Q14,
    F10). SQL ``!=`` semantics: a comparison with NULL is not a mismatch.
    ``pairs`` = (name, child_col, parent_col)."""
    cond = reduce(lambda a, b: a | b, [F.col(c) != F.col(p) for _, c, p in pairs])
    cols = keep + [x for _, c, p in pairs for x in (c, p)]
    return joined.where(cond).select(*cols)


def mismatch_long(joined: DataFrame, pairs: list[tuple[str, str, str]], by: list[str]) -> DataFrame:
    """(by..., column_name, child_value, parent_value) for every differing
    cell: the unpivoted form used by the counts and the value pairs."""
    cells = [F.struct(F.lit(n).alias("column_name"), F.col(c).cast("string").alias("child_value"),
                      F.col(p).cast("string").alias("parent_value"),
                      (F.col(c) != F.col(p)).alias("__diff"))
             for n, c, p in pairs]
    # Only rows with some mismatch are unpivoted (usually a small share).
    any_diff = reduce(lambda a, b: a | b, [F.col(c) != F.col(p) for _, c, p in pairs])
    return (joined.where(any_diff).select(*by, F.explode(F.array(*cells)).alias("__c"))
            .select(*by, "__c.*").where("__diff").drop("__diff"))


def mismatch_counts(joined: DataFrame, pairs: list[tuple[str, str, str]], by: list[str]) -> DataFrame:
    """Differing cells per compared column (A22): one aggregation, unpivoted.
    A missing copy beside a value differs from it; two missing cells agree."""
    aggs = [F.count_if(~F.col(c).eqNullSafe(F.col(p))).alias(n) for n, c, p in pairs]
    wide = joined.groupBy(*by).agg(*aggs)
    return wide.unpivot(by, [n for n, _, _ in pairs], "column_name", "mismatches")


def mismatch_pairs(joined: DataFrame, pairs: list[tuple[str, str, str]], by: list[str]) -> DataFrame:
    """Frequency of each (child value, parent value) mismatch."""
    long = mismatch_long(joined, pairs, by)
    return long.groupBy(*by, "column_name", "child_value", "parent_value") \
        .agg(F.count(F.lit(1)).alias("n"))


def share_of_total(counts: DataFrame, totals: DataFrame, on: list[str], count_col: str,
                   total_col: str, digits: int = 4) -> DataFrame:
    """count / total x 100 per key."""
    j = counts.join(totals, on=on, how="inner")
    return j.withColumn("percent", F.round(F.col(count_col) * 100.0 / F.col(total_col), digits))
