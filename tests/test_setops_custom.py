import datetime as dt

from tramline.operators import setops as U
from tramline.operators.projection import drop_if_clean, map_batches
from tramline.operators.quality import date_disagreement
from tests.conftest import rows


def test_set_operations(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(2,), (4,)], "k int")
    assert rows(U.union_distinct(a, b)) == [(1,), (2,), (3,), (4,)]
    assert rows(U.intersect(a, b)) == [(2,)]
    assert rows(U.difference(a, b)) == [(1,), (3,)]
    c = spark.createDataFrame([(5, "x")], "k int, extra string")
    assert rows(U.union_all([a, c], allow_missing=True)) == [(1, None), (2, None), (2, None), (3, None), (5, "x")]


def test_drop_if_clean(spark):
    d = dt.date(2022, 1, 1)
    same = spark.createDataFrame([(d, d, d)], "a date, b date, c date")
    assert drop_if_clean(same, date_disagreement(same, ["a", "b", "c"]), "different_dates", ["b", "c"]).columns == ["a"]
    diff = spark.createDataFrame([(d, d, dt.date(2022, 1, 2))], "a date, b date, c date")
    assert drop_if_clean(diff, date_disagreement(diff, ["a", "b", "c"]), "different_dates", ["b", "c"]).columns == \
        ["a", "b", "c"]


def test_map_batches(spark):
    df = spark.createDataFrame([(1,), (2,)], "x long")
    out = map_batches(df, lambda p: p.assign(y=p.x * 10), "x long, y long")
    assert rows(out) == [(1, 10), (2, 20)]


def test_scale_settings():
    from tramline.session import scale_settings
    s = scale_settings(100 * 2 ** 40, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(10 << 20, 8)["spark.sql.shuffle.partitions"] == "24"
