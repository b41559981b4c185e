"""Invariants over generated frames (few examples each: every example runs
Spark jobs)."""
import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tramline.operators import describe as Dm
from tramline.operators import ordering as O
from tramline.operators import quality as Q
from tramline.operators.joins import key_join
from tests.conftest import broadcasts

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=0, max_size=30)


@SETTINGS
@given(child=keys, parent=keys, small=st.booleans())
def test_semi_plus_anti_is_all(spark, child, parent, small):
    c = spark.createDataFrame([(i, k) for i, k in enumerate(child)], "rid long, k long")
    p = spark.createDataFrame([(k,) for k in parent], "k long")
    with broadcasts(spark, small):
        semi = {r.rid for r in key_join(c, p, [("k", "k")], "left_semi").collect()}
        anti = {r.rid for r in key_join(c, p, [("k", "k")], "left_anti").collect()}
    assert semi | anti == set(range(len(child))) and not semi & anti
    assert semi == {i for i, k in enumerate(child) if k is not None and k in set(parent)}


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 2))), max_size=40))
def test_dedup_idempotent_and_counted(spark, vals):
    df = spark.createDataFrame(vals, "a long, b long")
    once = Q.dedup_exact(df)
    assert once.count() == len(set(vals))
    assert Q.dedup_exact(once).count() == once.count()
    before, after, removed = Q.dedup_counts(df).first()
    assert (before, after, removed) == (len(vals), len(set(vals)), len(vals) - len(set(vals)))


@SETTINGS
@given(ks=st.lists(st.integers(-1000, 1000), unique=True, max_size=60), parts=st.integers(1, 6))
def test_row_numbers_are_a_permutation(spark, ks, parts):
    df = spark.createDataFrame([(k,) for k in ks], "k long")
    got = sorted((r.row_id, r.k) for r in O.with_row_number(df, ["k"], n_partitions=parts).collect())
    assert got == list(zip(range(1, len(ks) + 1), sorted(ks)))


@SETTINGS
@given(vals=st.lists(st.integers(-50, 50), min_size=1, max_size=200),
       probs=st.lists(st.floats(0, 1), min_size=1, max_size=4), narrow=st.booleans())
def test_exact_quantiles_match_numpy(spark, vals, probs, narrow):
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    old = Dm.WINDOW_ROWS
    Dm.WINDOW_ROWS = 5 if narrow else old            # force the sketch-narrowing rounds
    try:
        got = Dm.exact_quantiles(df, "x", probs)
    finally:
        Dm.WINDOW_ROWS = old
    assert np.allclose(got, np.quantile(np.array(vals, dtype=float), probs), atol=1e-9)
