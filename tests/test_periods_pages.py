"""Period tables, page indexes, rescued cells, joined files, prefix scans and
shared passes on small frames with nulls, ties, hot groups and empty input."""
import glob
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tramline.operators import aggregates as A
from tramline.operators import describe as Dm
from tramline.operators import ordering as O
from tramline.operators import quality as Q
from tramline.operators.paging import PageIndex
from tramline.operators.projection import conform
from tramline.session import scratch_path
from tramline.sources import files, sinks
from tramline.sources.periods import PeriodTable
from tramline.sources.reports import parse_sectioned_report, read_report_lines, render_sectioned_report, write_report


# --- periods ----------------------------------------------------------------

def _filed(spark):
    return spark.createDataFrame([(1, 2020, 2020), (2, 2020, 2021), (3, 2021, 2021), (4, 2022, 2022), (5, 2022, None), (6, 2023, 2019)],
                                 "id int, jahr int, true int")


def test_only_touched_periods_are_rewritten(spark):
    t = PeriodTable(spark, scratch_path(spark, "t"), "x", "jahr")
    t.write(_filed(spark), version="v1")
    moves = t.refile(F.col("true"), version="v2")
    assert rows(moves) == [(2020, 2021, 1), (2023, 2019, 1)]
    assert t.files() == {2019: "v2", 2020: "v2", 2021: "v2", 2022: "v1"}              # 2022 as it was, 2023 empty
    assert rows(t.read(), "id", "jahr") == [(1, 2020), (2, 2021), (3, 2021), (4, 2022), (5, 2022), (6, 2019)]
    assert rows(t.read("v1"), "id", "jahr") == [(1, 2020), (2, 2020), (3, 2021), (4, 2022), (5, 2022), (6, 2023)]
    assert rows(t.read(periods=[2021]), "id") == [(2,), (3,)]
    assert not os.path.exists(f"{t.root}/data/v=v2/jahr=2022")


def test_second_run_writes_nothing(spark):
    t = PeriodTable(spark, scratch_path(spark, "t"), "x", "jahr")
    t.write(_filed(spark))
    assert t.refile(F.col("true")) is not None
    before = sorted(glob.glob(f"{t.root}/**", recursive=True))
    assert t.refile(F.col("true")) is None
    assert sorted(glob.glob(f"{t.root}/**", recursive=True)) == before


def test_a_run_stopped_before_its_manifest_changes_nothing(spark, monkeypatch):
    t = PeriodTable(spark, scratch_path(spark, "t"), "x", "jahr")
    t.write(_filed(spark), version="v1")
    want = rows(t.read())
    create = type(spark).createDataFrame
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            t.refile(F.col("true"), version="v2")
    assert type(spark).createDataFrame is create
    assert t.version() == "v1" and rows(t.read()) == want
    t.refile(F.col("true"), version="v3")
    assert rows(t.read(), "id") == [(i,) for i in range(1, 7)]


def test_empty_and_unnamed_periods(spark):
    t = PeriodTable(spark, scratch_path(spark, "t"), "x", "jahr")
    t.write(_filed(spark).limit(0))
    assert t.files() == {} and t.read().count() == 0 and t.read().columns == ["id", "jahr", "true"] and t.refile(F.col("true")) is None
    u = PeriodTable(spark, scratch_path(spark, "t"), "x", "jahr")
    u.write(spark.createDataFrame([(1, None, 2020), (2, 2021, None)], "id int, jahr int, true int"))
    assert rows(u.refile(F.col("true"))) == [(None, 2020, 1)]
    assert rows(u.read(), "id", "jahr") == [(1, 2020), (2, 2021)]


# --- pages ------------------------------------------------------------------

def test_pages_equal_the_sorted_table(spark):
    rng = random.Random(2)
    data = [(i, rng.choice([None, 1, 2, 3, 50]), "x" * rng.randint(0, 3)) for i in range(500)]
    df = spark.createDataFrame(data, "id int, v int, s string").repartition(3)
    index = PageIndex.build(df, ["v", "id"], scratch_path(spark, "pages"), n_partitions=5)
    want = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    again = PageIndex(spark, index.path)                              # opened from what was written
    assert again.n_rows == 500 and again.columns == ["id", "v", "s"]
    for page in (1, 2, 17, 50, 51):
        assert [tuple(r) for r in again.page(page, 10).collect()] == want[(page - 1) * 10:page * 10]
    assert [tuple(r) for r in again.rows(95, 300).collect()] == want[95:395]


def test_a_page_reads_its_partitions_only(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    index = PageIndex.build(df, ["k"], scratch_path(spark, "pages"), n_partitions=10)
    deep = index.page(90, 10)
    assert [r.k for r in deep.collect()] == list(range(890, 900))
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(__pid#\d+\), \(__pid#\d+ = 8\)\]", plan)
    assert "GreaterThanOrEqual(__row_no,890)" in plan
    assert PageIndex.build(df.limit(0), ["k"], scratch_path(spark, "pages")).page(1).count() == 0


# --- cells that do not fit --------------------------------------------------

def test_rescued_cells(spark, tmp_path):
    path = str(tmp_path / "in")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("linie,preis,tag\n1,2.5,2021-01-02\n40000,x,2021-13-01\n,,\n7,1\n8,3.5,2021-01-03,more\n")
    schema = "linie smallint, preis double, tag date"
    plain = files.read_csv(spark, path, schema)
    assert plain.count() == 5
    got = files.read_csv(spark, path, schema, rescue="lost")
    assert dict(got.dtypes)["linie"] == "smallint"
    cells = sorted(((r.column_name, r.value) for r in files.rejected_cells(got, "lost").collect()), key=str)
    assert cells == [("linie", "40000"), ("preis", "x"), ("tag", "2021-13-01"), (None, "7,1"), (None, "8,3.5,2021-01-03,more")]
    assert rows(files.rejected_counts(got, "lost")) == [("linie", 1), ("preis", 1), ("tag", 1), (None, 2)]
    seen, watch = files.reject_observation(got, "lost")
    assert seen.count() == 5
    assert watch.get == {"rows": 5, "rows_rejected": 3, "cells_rejected": 5}
    some = files.read_csv(spark, path, schema, columns=["preis"], rescue="lost")
    assert some.columns == ["preis", "lost"]
    with pytest.raises(ValueError):
        files.read_csv(spark, path, rescue="lost")


def test_conform_keeps_what_it_cannot_cast(spark):
    df = spark.createDataFrame([("1", 3), ("1.5", 4), (None, 70000)], "a string, b int")
    out = conform(df, T.StructType.fromDDL("a int, b smallint, c string"), rescue="lost")
    assert [[tuple(x) for x in r.lost] for r in out.collect()] == [[], [("a", "1.5")], [("b", "70000")]]
    assert [(r.a, r.b, r.c) for r in out.collect()] == [(1, 3, None), (None, 4, None), (None, None, None)]
    same = conform(df, df.schema, rescue="lost")
    assert all(r.lost == [] for r in same.collect())


def test_header_columns_without_marks(spark, tmp_path):
    path = str(tmp_path / "h.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('﻿"a";b ;"c"\n1;2;3\n')
    assert files.header_columns(spark, path, ";") == ["a", "b", "c"]
    assert files.pick_separator(spark, path, ["a", "b", "c"]) == ";"


def test_random_files(spark, tmp_path):
    for i in range(12):
        os.makedirs(tmp_path / f"y{i % 3}", exist_ok=True)
        (tmp_path / f"y{i % 3}" / f"f{i}.csv").write_text(f"a\n{i}\n" if i else "")
    drawn = files.random_files(spark, str(tmp_path), 5, seed=1)
    assert len(set(drawn)) == 5 and drawn == files.random_files(spark, str(tmp_path), 5, seed=1)
    assert any(files.random_files(spark, str(tmp_path), 5, seed=s) != drawn for s in (2, 3, 4))
    assert len(files.random_files(spark, str(tmp_path), 100)) == 12                   # the empty one too
    assert files.list_files(spark, str(tmp_path)).count() == 12
    assert files.read_csv(spark, [p for p in drawn if not p.endswith("f0.csv")], "a int").where("a IS NULL").count() == 0


# --- one file ---------------------------------------------------------------

@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_parts_joined_to_one_file(spark, tmp_path, fmt):
    df = spark.range(1000).select("id", F.concat(F.lit('a "q", \n'), F.col("id").cast("string")).alias("te,xt")).repartition(7)
    path = sinks.write_single_file(df, str(tmp_path / "one"), fmt, order_by=["id"])
    assert os.listdir(tmp_path) == ["one"] and path.endswith(f"data.{fmt}")
    r = spark.read.schema("id long, `te,xt` string")
    back = r.option("header", True).option("multiLine", True).option("escape", "\\").csv(path) if fmt == "csv" else r.json(path)
    assert rows(back) == rows(df) and back.columns == df.columns
    assert [x.id for x in back.limit(5).collect()] == [0, 1, 2, 3, 4]                  # in order of the parts
    with pytest.raises(ValueError):
        sinks.write_single_file(df, str(tmp_path / "two"), "parquet")


def test_single_file_of_an_empty_table(spark, tmp_path):
    path = sinks.write_single_file(spark.createDataFrame([], "a int, b string"), str(tmp_path / "one"))
    assert open(path).read() == "a,b\n"


# --- prefix scans -----------------------------------------------------------

def test_carry_forward_over_partitions(spark):
    rng = random.Random(5)
    data = [(g, i, rng.choice([None] * 9 + [f"h{i}"])) for g, n in (("hot", 400), ("b", 7), (None, 30)) for i in range(n)]
    df = spark.createDataFrame(data, "f string, pos int, h string").repartition(4)
    got = rows(O.carry_forward(df, ["f"], "pos", "h", "cur", n_partitions=9), "f", "pos", "cur")
    want, last = [], {}
    for f, pos, h in sorted(data, key=lambda r: (str(r[0]), r[1])):
        last[f] = h or last.get(f)
        want.append((f, pos, last[f]))
    assert got == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert O.carry_forward(df.limit(0), ["f"], "pos", "h", "cur").count() == 0


def test_running_total(spark):
    df = spark.createDataFrame([(k, k % 5 + 1) for k in range(200)], "k int, w long")
    got = {r.k: r.before for r in O.running_total(df, ["k"], "w", "before", n_partitions=7).collect()}
    assert got == {k: sum(j % 5 + 1 for j in range(k)) for k in range(200)}


def test_report_over_many_splits(spark, tmp_path):
    counts = spark.createDataFrame([(y, f"c{i}", i) for y in range(2000, 2020) for i in range(60)], "yr int, name string, n long")
    lines = render_sectioned_report(counts, F.lit(1), "yr", "name", "n", "Total Time: 1.5 seconds")
    path = str(tmp_path / "rep")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        write_report(lines, path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        back = read_report_lines(spark, path)
        assert back.rdd.getNumPartitions() > 3 and back.select("file").distinct().count() == 1
        assert rows(parse_sectioned_report(back, ["file"], "pos", "line")) == rows(counts)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_equal_count_lines_stay(spark):
    counts = spark.createDataFrame([(2016, "a", 5), (2016, "a", 5), (2016, "b", 1)], "yr int, name string, n long")
    lines = render_sectioned_report(counts, F.lit(1), "yr", "name", "n", "end")
    assert sorted(r.line.strip() for r in lines.collect()) == ["-----------------------------------", "Year: 2016", "a: 5", "a: 5", "b: 1", "end"]


# --- shared passes ----------------------------------------------------------

def test_all_columns_described_together(spark, monkeypatch):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 4000).round(3), rng.integers(0, 3, 4000)
    df = spark.createDataFrame([(float(x), int(y), None, float("nan") if i % 2 else -0.0) for i, (x, y) in enumerate(zip(a, b))],
                               "a double, b int, none double, half double").repartition(3)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for bound in (20_000, 3):                                        # read by the driver, ranked in a job
        got, _ = Dm.quantiles_of_columns(df, df.columns, probs, window_rows=bound)
        assert np.allclose(got["a"], np.quantile(a, probs)) and np.allclose(got["b"], np.quantile(b, probs))
        assert got["none"] == [None] * 6 and got["half"] == [0.0] * 6
    out = {r.column_name: r for r in Dm.describe_columns(df).collect()}
    assert (out["none"]["count"], out["none"]["mean"], out["none"]["p50"]) == (0, None, None)
    assert out["half"]["count"] == 2000 and out["a"]["count"] == 4000


def test_describe_reads_its_input_three_times_at_most(spark):
    reads = spark.sparkContext.accumulator(0)
    base = spark.range(0, 3000, 1, 1).select(*[F.rand(i).alias(f"c{i}") for i in range(12)])

    def counted(batches):
        reads.add(1)
        yield from batches
    df = base.mapInPandas(counted, base.schema)
    assert Dm.describe_columns(df).count() == 12
    assert reads.value <= 3


def test_distinct_in_one_pass_equals_by_column(spark):
    import datetime as dt
    from decimal import Decimal
    data = [(1, 1.5, "a", True, dt.date(2020, 1, 1), Decimal("1.10"), [1, 2], bytearray(b"x")),
            (1, -0.0, "", None, None, None, None, None), (None, 0.0, None, False, dt.date(2020, 1, 1), Decimal("1.10"), [], bytearray(b"")),
            (2, float("nan"), "a", True, dt.date(2021, 1, 1), Decimal("2"), [1, 2], bytearray(b"x")), (2, float("nan"), "b", True, None, None, [2, 1], None)]
    df = spark.createDataFrame(data, "i int, d double, s string, b boolean, t date, x decimal(5,2), l array<int>, y binary")
    assert rows(A.distinct_counts(df, one_pass=True)) == rows(A.distinct_counts(df))
    assert rows(A.unique_profile(df, one_pass=True)) == rows(A.unique_profile(df))
    joined = df.join(df.select("i").distinct(), "i")
    assert A.unique_profile(joined, one_pass=True)._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_repeats_of_a_hot_key(spark):
    data = [(1, "a")] * 25_000 + [(1, "b"), (2, "c"), (None, "x"), (None, "x"), (3, None), (3, None)]
    df = spark.createDataFrame(data, "k int, v string").repartition(4)
    got = Q.repeats_after_first(df, ["k"], ["v"]).groupBy("k", "v").count().collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "a", 24_999), (1, "b", 1), (None, "x", 1), (3, None, 1)], key=str)


def test_shared_keys_in_one_pass(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (1, 1, 2), (2, 1, 1), (None, 1, 1), (3, 3, None), (3, 3, None)], "a int, b int, c int")
    assert tuple(Q.same_key_counts(df, ["a", "b"], ["c"], ["a"]).first()) == (5, 4)
    assert tuple(Q.same_key_counts(df.limit(0), ["a", "b"], ["c"], ["a"]).first()) == (0, 0)
