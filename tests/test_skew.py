"""A key holding a third of all rows: results stay exact and whole, and the
join back of the group operators is split by AQE instead of landing in one
task."""
import pytest
from pyspark.sql import functions as F

from tramline.operators import ordering as O
from tramline.operators import quality as Q
from tramline.operators.joins import semi


@pytest.fixture()
def skewed(spark):
    n = 60000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("pos"), (F.col("id") % 97).alias("v"))
    return df, n


def test_hot_key_results_exact(spark, skewed):
    df, n = skewed
    hot = n // 3
    sizes = O.attach_group_size(df, ["k"])
    assert sizes.count() == n                                       # no row dropped or multiplied
    assert sizes.where("k = 7").select(F.max("group_size")).first()[0] == hot + (1 if 7 % 3 else 0)
    rep = Q.repeats_after_first(df, ["k"], ["pos"])
    assert rep.count() == n - df.select("k").distinct().count()
    assert tuple(Q.dedup_counts(df.select("k")).first())[2] == rep.count()
    keys = df.select(F.col("k").alias("id"))
    assert semi(spark.range(10), keys, "id").count() == 6          # multiples of 3 all became key 7


def test_hot_key_join_back_is_split(spark, skewed):
    df, _ = skewed
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = O.attach_group_size(df, ["k"])
        assert len(out.collect()) == 60000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan.replace(" ", "")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_anti_join_paths_agree(spark):
    from tramline.operators.joins import key_join
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (5,)], "k long")
    parent = spark.createDataFrame([(2,), (2,), (None,), (5,)], "k long")
    from tests.conftest import broadcasts
    for allowed in (True, False):
        with broadcasts(spark, allowed):
            assert sorted(r.k or -1 for r in key_join(child, parent, [("k", "k")], "left_anti").collect()) == [-1, 1]
