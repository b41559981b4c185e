import random

from pyspark.sql import functions as F

from tramline.operators import ordering as O
from tests.conftest import rows


def test_row_number_is_consecutive_and_ordered(spark):
    keys = random.Random(1).sample(range(100000), 500)
    df = spark.createDataFrame([(k, f"n{k}") for k in keys], "k long, name string")
    got = O.with_row_number(df, ["k"], "rid", start=26, n_partitions=7).collect()
    by_rid = sorted((r.rid, r.k) for r in got)
    assert [r for r, _ in by_rid] == list(range(26, 526))
    assert [k for _, k in by_rid] == sorted(keys)


def test_row_number_text_key(spark):
    df = spark.createDataFrame([(w,) for w in ["d", "b", "a", "c", "e"]], "w string")
    got = sorted((r.row_id, r.w) for r in O.with_row_number(df, ["w"], n_partitions=3).collect())
    assert got == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]


def test_page_head_tail(spark):
    df = spark.range(1, 36).withColumnRenamed("id", "k")
    assert [r.k for r in O.page(df, ["k"], 3, 10).collect()] == list(range(21, 31))
    assert [r.k for r in O.page(df, ["k"], 4, 10).collect()] == list(range(31, 36))
    assert [r.k for r in O.tail(df, ["k"], 5).collect()] == list(range(31, 36))


def test_group_size_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (2, 4), (2, 5)], "k int, v int")
    assert rows(O.attach_group_size(df, ["k"]), "v", "group_size") == [(1, 2), (2, 2), (3, 1), (4, 2), (5, 2)]


def test_group_agg(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 5.0), (2, 1.0)], "k int, v double")
    assert rows(O.attach_group_agg(df, ["k"], F.max("v"), "m"), "v", "m") == [(1.0, 1.0), (3.0, 5.0), (5.0, 5.0)]


def test_flag_repeats_first_by_order(spark):
    df = spark.createDataFrame([(1, 30), (1, 10), (1, 20), (None, 5), (None, 6), (2, 1)], "k int, pos int")
    got = rows(O.flag_repeats(df, ["k"], ["pos"]), "k", "pos", "is_repeat")
    assert got == [(1, 10, False), (1, 20, True), (1, 30, True), (2, 1, False), (None, 5, False), (None, 6, True)]


def test_top_k_ties_broken_by_key(spark):
    df = spark.createDataFrame([(k, n) for k, n in [(5, 3), (2, 3), (9, 1), (1, 2), (7, 3)]], "k int, n int")
    assert [r.k for r in O.top_k_by(df, "n", 3, ["k"]).collect()] == [2, 5, 7]
    assert [r.k for r in O.top_k_by(df, "n", 10, ["k"]).collect()] == [2, 5, 7, 1, 9]


def test_carry_forward(spark):
    df = spark.createDataFrame([("f", 1, "A"), ("f", 2, None), ("f", 3, "B"), ("f", 4, None), ("g", 1, None)],
                               "file string, pos int, h string")
    got = rows(O.carry_forward(df, ["file"], "pos", "h", "cur"), "file", "pos", "cur")
    assert got == [("f", 1, "A"), ("f", 2, "A"), ("f", 3, "B"), ("f", 4, "B"), ("g", 1, None)]


def test_no_single_partition_window(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    plan = O.with_row_number(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_row_number_nulls_first(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (2,)], "k int")
    got = sorted((r.row_id, r.k) for r in O.with_row_number(df, ["k"], n_partitions=2).collect())
    assert got == [(1, None), (2, 1), (3, 2), (4, 3)]


def test_one_first_row_per_key_despite_ties(spark):
    from tramline.operators import quality as Q
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (2, "c"), (3, None), (None, "x"), (None, "x")], "k int, v string")
    assert rows(Q.repeats_after_first(df, ["k"], ["v"])) == [(1, "a"), (1, "b"), (2, "c"), (None, "x")]
    flagged = O.flag_repeats(df, ["k"], ["k"]).collect()
    assert len(flagged) == 8 and sum(not r.is_repeat for r in flagged) == 4


def test_rename_chain(spark):
    from tramline.operators.projection import apply_operations
    df = spark.createDataFrame([(1, 2)], "a int, x int")
    assert apply_operations(df, ["RENAME a TO b", "RENAME b TO c", "RENAME x TO a"]).columns == ["c", "a"]


def test_large_period_is_dealt_to_several_files(spark, tmp_path):
    import glob
    from tramline.sources import sinks
    df = spark.range(200000).selectExpr("id", "uuid() AS v", "IF(id % 10 < 9, 2021, 2022) AS jahr")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        sinks.write_partitioned(df, str(tmp_path / "o"), "jahr")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(glob.glob(f"{tmp_path}/o/jahr=2021/*.parquet")) > 1
    assert spark.read.parquet(str(tmp_path / "o")).groupBy("jahr").count().count() == 2
