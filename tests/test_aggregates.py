import datetime as dt

from pyspark.sql import functions as F

from tramline.operators import aggregates as A
from tests.conftest import rows


def test_distinct_counts_null_is_a_value(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (1, None, -0.0), (None, "b", 1.0), (2, "a", None)],
                               "x int, s string, d double")
    assert rows(A.distinct_counts(df)) == [("d", 3), ("s", 3), ("x", 3)]
    assert rows(A.distinct_counts(df, null_is_value=False)) == [("d", 2), ("s", 2), ("x", 2)]


def test_unique_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "x int, s string")
    assert rows(A.unique_profile(df)) == [("s", 2, False), ("x", 3, True)]


def test_empty_profile_and_total(spark):
    df = spark.createDataFrame([("", 1), (None, None), ("x", 3), ("y", 4)], "s string, n int")
    assert rows(A.empty_profile(df)) == [("n", 1, 25.0), ("s", 2, 50.0)]
    assert A.empty_total(df).first()[0] == 3
    split = A.empty_profile_split(df, F.col("n") > 2)
    assert rows(split) == [("n", 0, 1), ("s", 0, 2)]


def test_empty_profile_empty_frame(spark):
    df = spark.createDataFrame([], "s string")
    assert rows(A.empty_profile(df)) == [("s", 0, None)]


def test_value_counts_drops_nulls_and_orders(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v string")
    assert [tuple(r) for r in A.value_counts(df, "v").collect()] == [("a", 2), ("b", 1)]


def test_date_rollup_levels(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1),), (dt.date(2022, 1, 2),), (dt.date(2022, 2, 1),)], "d date")
    r = {(x.yr, x.mon, x.dom, x.level): x.n for x in A.date_rollup(df, "d").collect()}
    assert r[(None, None, None, 7)] == 3
    assert r[(2022, 1, None, 1)] == 2
    assert r[(2022, 2, 1, 0)] == 1


def test_weekday_totals_and_series(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 6),), (dt.date(2024, 1, 6),)], "d date")
    assert [tuple(r) for r in A.weekday_totals(df, "d").collect()] == [(0, "Monday", 1), (5, "Saturday", 2)]
    s = {r.day: (r.doy, r.is_weekend, r.n) for r in A.daily_series(df, "d").collect()}
    assert s[dt.date(2024, 1, 6)] == (6, True, 2)


def test_boolean_share(spark):
    df = spark.createDataFrame([(True,), (False,), (True,), (True,)], "b boolean")
    assert tuple(A.boolean_share(df, F.col("b")).first()) == (3, 1, 75.0)


def test_empty_profile_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert rows(A.empty_profile(df)) == [("x", 2, 66.6667)]
