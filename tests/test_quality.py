import datetime as dt

from pyspark.sql import functions as F

from tramline.operators import quality as Q
from tests.conftest import broadcasts, rows


def test_dedup_counts_and_exact(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    assert tuple(Q.dedup_counts(df).first()) == (5, 3, 2)
    assert rows(Q.dedup_exact(df)) == [(1, "a"), (2, None), (3, "c")]


def test_duplicate_rows_keep_false_and_repeats(spark):
    df = spark.createDataFrame([(1, 1, 9), (1, 1, 8), (2, 1, 7), (None, 1, 6), (None, 1, 5)], "a int, b int, o int")
    assert rows(Q.duplicate_rows(df, ["a", "b"]), "o") == [(5,), (6,), (8,), (9,)]
    assert rows(Q.repeats_after_first(df, ["a", "b"], ["o"]), "o") == [(6,), (9,)]


def test_same_key_counts(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, None), (1, 1.0, 1.0, None), (1, 1.0, 1.0, 3.0),
                                (1, None, 1.0, 4.0), (1, None, 1.0, 4.0), (2, 2.0, 2.0, 1.0)],
                               "y int, lat double, lon double, bearing double")
    r = Q.same_key_counts(df, ["y", "lat", "lon"], ["bearing"], ["lat", "lon"]).first()
    assert (r.same, r.also_same) == (3, 2)


def test_rule_violations_null_counts_as_violation(spark):
    df = spark.createDataFrame([(1, 5), (3, 2), (None, 1)], "a int, b int")
    res = {r.rule: (r.violations, r.all_pass) for r in
           Q.rule_violations(df, [("f", "a small", "a <= 2"), ("f", "b positive", "b > 0")]).collect()}
    assert res == {"a small": (2, False), "b positive": (0, True)}


def test_orphans_counted_per_side(spark):
    child = spark.createDataFrame([(1, 10, 100, 2020), (2, 11, 100, 2020), (3, 99, 999, 2021), (4, None, 100, 2021)],
                                  "id int, a int, b int, yr int")
    pa = spark.createDataFrame([(10,), (11,)], "a int")
    pb = spark.createDataFrame([(100,)], "b int")
    o = Q.orphan_rows(child, [("a", pa, "a", "a"), ("b", pb, "b", "b")], ["id"], period=F.col("yr"))
    # row 3 fails both sides and is counted twice; a NULL key is an orphan
    assert rows(o, "id", "side") == [(3, "a"), (3, "b"), (4, "a")]
    assert rows(Q.orphan_counts(o, ["period"])) == [(2021, 3)]
    # keys of both sides: 99 is a parent later, 999 only before and in the same year, the null key never
    parents = spark.createDataFrame([("a", 99, 2020), ("a", 99, 2023), ("b", 999, 2020), ("b", 999, 2021),
                                     ("b", 99, 2022)], "side string, fk_value int, period int")
    assert rows(Q.orphans_reappear(o, parents, ["side", "fk_value"])) == [(2021, 3, 1)]


def test_mismatch_semantics(spark):
    df = spark.createDataFrame([(2020, 1, 1, "a", "a"), (2020, 2, 1, None, "b"), (2021, 1, 1, "x", "y")],
                               "yr int, f int, p int, fs string, ps string")
    pairs = [("num", "f", "p"), ("txt", "fs", "ps")]
    assert rows(Q.mismatch_rows(df, pairs, ["yr"]), "yr") == [(2020,), (2021,)]
    assert rows(Q.mismatch_counts(df, pairs, ["yr"])) == [(2020, "num", 1), (2020, "txt", 1),   # a missing copy differs
                                                          (2021, "num", 0), (2021, "txt", 1)]
    assert rows(Q.mismatch_pairs(df, pairs, ["yr"])) == [(2020, "num", "2", "1", 1), (2021, "txt", "x", "y", 1)]


def test_date_disagreement_and_partial_fill(spark):
    d = dt.date(2022, 1, 1)
    df = spark.createDataFrame([(d, d, d), (d, d, dt.date(2022, 1, 2)), (d, None, d)], "a date, b date, c date")
    assert tuple(Q.date_disagreement(df, ["a", "b", "c"]).first()) == (1, 1)
    t = spark.createDataFrame([("a", "b"), ("", "b"), (None, None)], "x string, y string")
    assert Q.partially_filled(t, ["x", "y"]).first()[0] == 1


def test_share_of_total(spark):
    c = spark.createDataFrame([(2020, "a", 5)], "yr int, col string, n long")
    t = spark.createDataFrame([(2020, 20)], "yr int, total long")
    assert Q.share_of_total(c, t, ["yr"], "n", "total").first().percent == 25.0


def test_orphan_paths_agree(spark):
    child = spark.createDataFrame([(1, 10, 100, 2020), (2, 11, 100, 2020), (3, 99, 999, 2021), (4, None, 100, 2021)],
                                  "id int, a int, b int, yr int")
    pa = spark.createDataFrame([(10, 2020), (11, 2020), (11, 2021)], "a int, yr int")
    pb = spark.createDataFrame([(100,)], "b int")
    checks = [("a", pa, ["a", "yr"], ["a", "yr"]), ("b", pb, "b", "b")]
    for allowed in (True, False):
        with broadcasts(spark, allowed):
            assert rows(Q.orphan_rows(child, checks, ["id"]), "id", "side") == [(3, "a"), (3, "b"), (4, "a")]
    plan = Q.orphan_rows(child, checks, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1                                  # one anti join for all sides
