import pytest
from pyspark.sql import functions as F

from tramline.operators import repair as R
from tramline.operators import snapshots as S
from tramline.operators.joins import fill_from_parent, lookup_fill
from tests.conftest import rows

SNAP = [(1, 2016, "a", None, True), (1, 2017, "a", None, False), (1, 2018, "b", 1, True),
        (2, 2016, "x", 5, False), (3, 2017, "y", 1, True), (3, 2018, "y", 1, True)]
SCHEMA = "id int, jahr int, name string, grp int, aktiv boolean"


def test_changed_cells_null_equals_null(spark):
    df = spark.createDataFrame(SNAP, SCHEMA)
    assert rows(S.changed_cells(df, "id", "jahr", ["name", "grp"])) == [("grp", 1), ("name", 1)]


def test_missing_next_year_and_reactivated(spark):
    df = spark.createDataFrame(SNAP, SCHEMA)
    assert rows(S.ids_missing_next_year(df, "id", "jahr")) == [(2, 2016)]
    assert rows(S.reactivated(df, "id", "jahr", "aktiv")) == [(1, 2017)]


def test_latest_snapshot_and_gate(spark):
    df = spark.createDataFrame(SNAP, SCHEMA)
    assert rows(S.latest_snapshot(df, "id", "jahr")) == [(1, 2018, "b", 1, True), (2, 2016, "x", 5, False),
                                                         (3, 2018, "y", 1, True)]
    gate = S.merge_gate(df, "id", "jahr", ["grp"]).first()
    assert (gate.consistent, gate.contained, gate.mergeable) == (False, False, False)


def test_gate_asks_the_ledger(spark):
    df = spark.createDataFrame([(1, 2016, "a"), (1, 2017, "b"), (None, 2016, "x"), (2, 2017, "y"), (3, None, "z")], "id int, jahr int, name string")
    led = spark.createDataFrame([("A_Csv_Merging", 1.5), ("B_Csv_Merging", None)], "process string, time double")
    gate = lambda *a: tuple(S.merge_gate(df, "id", "jahr", *a).first())
    assert gate(["name"]) == (False, True, True, False)
    df = df.withColumn("name", F.lit("same"))
    assert gate(["name"]) == (True, True, True, True)
    assert gate(["name"], led, "A_Csv_Merging") == (True, True, False, False)
    assert gate(["name"], led, "B_Csv_Merging") == (True, True, True, True)


def test_copies_of_a_snapshot_row_count_once(spark):
    df = spark.createDataFrame(SNAP * 3, SCHEMA)
    assert rows(S.changed_cells(df, "id", "jahr", ["name", "grp"])) == [("grp", 1), ("name", 1)]
    assert rows(S.ids_missing_next_year(df, "id", "jahr")) == [(2, 2016)]
    assert rows(S.reactivated(df, "id", "jahr", "aktiv")) == [(1, 2017)]
    assert rows(S.latest_snapshot(df.unionByName(df.withColumn("name", F.lit("0"))), "id", "jahr"), "id", "name") == [(1, "b"), (2, "x"), (3, "y")]
    assert rows(S.last_year(spark.createDataFrame(SNAP, SCHEMA), "jahr"), "id") == [(1,), (3,)]
    assert S.changed_cells(df.limit(0), "id", "jahr", ["name"]).first().inconsistent == 0


def test_snapshot_checks_share_one_shuffle(spark):
    df = spark.createDataFrame(SNAP, SCHEMA)
    plan = S.merge_gate(df, "id", "jahr", ["grp"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_stack_years(spark):
    a = spark.createDataFrame([(1,)], "id int")
    b = spark.createDataFrame([(2,)], "id int")
    assert S.stack_years({2017: b, 2016: a}).columns == ["jahr", "id"]
    assert rows(S.stack_years({2017: b, 2016: a})) == [(2016, 1), (2017, 2)]


def test_keyed_patch_overwrites_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5.0, "x"), (3, 7.0, "y")], "uic long, lat double, link string")
    out = R.keyed_patch(df, "uic", {"lat": {1: 47.5, 2: None}, "link": {1: "u1"}})
    assert rows(out) == [(1, 47.5, "u1"), (2, None, "x"), (3, 7.0, "y")]


def test_patch_from_table(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y"), (3, 7.0, "z"), (None, 1.0, "n")], "k int, a double, b string")
    patch = spark.createDataFrame([(1, 9.0, None, ["a"]), (2, 5.0, None, ["a", "b"]), (3, 8.0, "q", []), (None, 0.0, "w", ["a"])],
                                  "k int, a double, b string, cells array<string>")
    assert rows(R.patch_from_table(df, "k", patch)) == [(1, 9.0, "x"), (2, 5.0, None), (3, 7.0, "z"), (None, 1.0, "n")]
    with pytest.raises(ValueError):
        R.patch_from_table(df, "k", patch.unionByName(patch))


def test_sentinel_bearing_idempotent(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (None, 2.0, None), (1.0, 2.0, 90.0)], "lat double, lon double, b double")
    once = R.add_sentinel_bearing(df, "lat", "lon", "b")
    assert rows(once, "b") == [(-1.0,), (90.0,), (None,)]
    assert rows(R.add_sentinel_bearing(once, "lat", "lon", "b")) == rows(once)


def test_narrowable_and_narrow(spark):
    df = spark.createDataFrame([(1.0, 1.5, 2.0), (3.0, 2.0, None)], "a double, b double, c double")
    assert rows(R.narrowable(df, ["a", "b", "c"])) == [("a", True), ("b", False), ("c", False)]
    out = R.narrow_integers(df, ["a", "b", "c"])
    assert dict(out.dtypes) == {"a": "bigint", "b": "double", "c": "double"}


def test_period_check(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2021, 12, 31), 2022), (dt.date(2022, 1, 1), 2022)], "d date, y int")
    assert rows(R.period_check(df, "d", "y"), "true_year", "wrong_period") == [(2021, True), (2022, False)]


def test_fill_from_parent_sets_flag_even_if_parent_empty(spark):
    child = spark.createDataFrame([(1, 10, None, None, 5.0), (2, 20, None, None, 6.0), (3, 10, 1.0, 2.0, 7.0),
                                   (4, 99, None, None, 8.0)], "id int, fk int, lat double, lon double, b double")
    parent = spark.createDataFrame([(10, 46.0, 7.0), (20, None, None)], "pk int, plat double, plon double")
    out = fill_from_parent(child, parent, "fk", "pk", {"lat": "plat", "lon": "plon"}, "lat", "b", -2.0)
    assert rows(out, "id", "lat", "lon", "b") == [(1, 46.0, 7.0, -2.0), (2, None, None, -2.0),
                                                  (3, 1.0, 2.0, 7.0), (4, None, None, 8.0)]


def test_lookup_fill_requires_unique_names(spark):
    child = spark.createDataFrame([("Bern", None)], "name string, lat double")
    reg = spark.createDataFrame([("Bern", 1.0), ("Bern", 2.0)], "n string, y double")
    with pytest.raises(ValueError):
        lookup_fill(child, reg, "name", "n", {"lat": "y"})
    ok = spark.createDataFrame([("Bern", 1.0)], "n string, y double")
    assert rows(lookup_fill(child, ok, "name", "n", {"lat": "y"})) == [("Bern", 1.0)]
