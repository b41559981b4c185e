"""Small library functions without a registered query."""
from pyspark.sql import functions as F

from tramline.operators import aggregates as A
from tramline.operators import filters as FL
from tramline.operators.ordering import head
from tramline.operators.projection import keep_columns
from tramline.sources.catalog import catalog_profile
from tests.conftest import rows


def test_approx_distinct_close_to_exact(spark):
    df = spark.range(0, 5000).select((F.col("id") % 1000).alias("a"), (F.col("id") % 7).alias("b"))
    approx = {r.column_name: r.n_distinct for r in A.approx_distinct_counts(df, rsd=0.02).collect()}
    assert abs(approx["a"] - 1000) <= 60 and approx["b"] == 7


def test_catalog_profile_lists_views(spark):
    spark.range(3).createOrReplaceTempView("tramline_v1")
    prof = {r.table_name: (r.n_columns, r.n_rows) for r in catalog_profile(spark).collect()}
    assert prof["tramline_v1"] == (1, 3)
    spark.catalog.dropTempView("tramline_v1")


def test_sampling_and_ranges(spark):
    df = spark.range(0, 10000).withColumnRenamed("id", "k")
    s1 = FL.hash_sample(df, "k", 10).count()
    assert 800 < s1 < 1200 and FL.hash_sample(df, "k", 10).count() == s1    # reproducible
    r = FL.random_sample(df, 0.1, seed=3).count()
    assert 800 < r < 1200
    assert df.where(FL.in_range(F.col("k"), 0, 86399)).count() == 10000


def test_head_and_keep_columns(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    assert [r.k for r in head(df, ["k"], 2).collect()] == [1, 2]
    assert keep_columns(df, ["v", "missing", "k"]).columns == ["v", "k"]
