"""Filters and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.text import search_match

# Multiplicative hash for reproducible samples: the key is first reduced
# modulo a prime so the product fits in 64 bits for any key size.
HASH_PRIME = 1_000_003
HASH_MULT = 2_654_435_761


def search(df: DataFrame, terms: list[tuple[str, str, bool]]) -> DataFrame:
    """Accumulated searches (F3): every (column, regex, negate) must hold."""
    conds = [search_match(F.col(c), pat, neg) for c, pat, neg in terms]
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def in_range(c: Column, lo, hi) -> Column:
    return c.between(lo, hi)


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """Deterministic bucket of a non-negative integer key, same in every
    engine that has 64-bit integers."""
    return F.pmod(F.pmod(key, F.lit(HASH_PRIME)) * F.lit(HASH_MULT), F.lit(HASH_PRIME)) % F.lit(buckets)


def hash_sample(df: DataFrame, key: str, percent: int, buckets: int = 100) -> DataFrame:
    """Reproducible sample of about ``percent`` % of the keys."""
    return df.where(hash_bucket(F.col(key), buckets) < F.lit(percent * buckets // 100))


def random_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample (``df.sample(frac=...)``)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def date_text_mismatch(c: Column, pattern: str = r"^[0-9]{2}\.[0-9]{2}\.[0-9]{2}") -> Column:
    """Text dates that do not start with the expected pattern."""
    return ~F.coalesce(c.rlike(pattern), F.lit(False))
