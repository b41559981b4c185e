import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators.projection import apply_operations, conform, with_leading_constant
from tramline.sources import files, sinks
from tramline.sources.catalog import sql_source, table_profile
from tramline.sources.ledger import Ledger, StepResult, ledger_rollup, run_steps
from tramline.sources.lookups import canton_table, counts_with_names
from tramline.sources.reports import parse_sectioned_report, read_report_lines
from tests.conftest import rows


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="tramline-test-")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_separator_schema_and_decimal_comma(spark, tmp):
    _write(f"{tmp}/hp/Haltepunkt.csv", "halt_punkt_id;GPS_Latitude;GPS_Longitude\n1;47,37;8,54\n2;;\n")
    assert files.pick_separator(spark, f"{tmp}/hp/Haltepunkt.csv", ["halt_punkt_id", "GPS_Latitude"]) == ";"
    assert files.header_columns(spark, f"{tmp}/hp/Haltepunkt.csv", ";") == ["halt_punkt_id", "GPS_Latitude",
                                                                             "GPS_Longitude"]
    schema = "halt_punkt_id long, GPS_Latitude string, GPS_Longitude string"
    df = files.read_csv(spark, f"{tmp}/hp/Haltepunkt.csv", schema, sep=";")
    df = files.with_decimal_comma(df, ["GPS_Latitude", "GPS_Longitude"])
    assert rows(df) == [(1, 47.37, 8.54), (2, None, None)]


def test_multi_file_scan_with_week_dates(spark, tmp):
    for a, b in [("20220102", "20220108"), ("20220109", "20220115")]:
        _write(f"{tmp}/fz/Fahrzeiten_SOLL_IST_{a}_{b}.csv", "linie,richtung\n2,1\n3,2\n")
    _write(f"{tmp}/fz/Haltestelle.csv", "x\n1\n")
    df = files.read_csv(spark, f"{tmp}/fz", "linie short, richtung byte", glob_filter="Fahrzeiten_*.csv")
    assert df.count() == 4
    weeks = files.file_week_dates(df).select("week_start", "week_end").distinct()
    assert [str(r.week_start) for r in weeks.orderBy("week_start").collect()] == ["2022-01-02", "2022-01-09"]
    listed = files.list_files(spark, f"{tmp}/fz", "Fahrzeiten_*.csv")
    assert listed.count() == 2


def test_versioned_sinks_never_overwrite(spark, tmp):
    df = spark.createDataFrame([(2021, 1), (2022, 2)], "year int, v int")
    p = sinks.write_versioned(df, tmp, "t", partition_by=["year"], version="1")
    assert sorted(f for f in os.listdir(p) if not f.startswith(".")) == ["_SUCCESS", "year=2021", "year=2022"]
    with pytest.raises(Exception):
        sinks.write_versioned(df, tmp, "t", version="1")
    sinks.write_single_file(df, f"{tmp}/single")
    assert len([f for f in os.listdir(f"{tmp}/single") if f.endswith(".csv")]) == 1
    with pytest.raises(AnalysisException):
        sinks.write_single_file(df, f"{tmp}/single")                # never over an existing result


def test_typed_table_nan_to_null(spark, tmp):
    spark.sql("DROP TABLE IF EXISTS tramline_typed")
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "id int, x double")
    sinks.save_typed_table(df, "tramline_typed", T.StructType([T.StructField("id", T.LongType()),
                                                               T.StructField("x", T.DoubleType())]))
    assert rows(spark.table("tramline_typed")) == [(1, None), (2, 1.5)]
    spark.sql("DROP TABLE tramline_typed")


def test_operations_list(spark):
    df = spark.createDataFrame([(1, 2, "a,b", "x")], "halt_id long, halt_diva long, halt_lang string, gone string")
    out = apply_operations(df, ["RENAME halt_id TO id", "RENAME missing TO other", "DROP gone",
                                "REPLACE AT halt_lang , WITH ;"])
    assert out.columns == ["id", "halt_diva", "halt_lang"]
    assert out.first().halt_lang == "a;b"
    assert with_leading_constant(out, "jahr", 2016).columns[0] == "jahr"
    typed = conform(spark.createDataFrame([("12", "x")], "a string, b string"),
                    T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))
    assert tuple(typed.first()) == (12, None)


def test_ledger_rollup_golden(spark):
    # Per-year ledger rows and their published totals (the original run ledger).
    data = [
        ("Fahrzeiten_2016_Deleting_Duplicate_Rows", 401.98, "Duplicate Rows: 0"),
        ("Fahrzeiten_2017_Deleting_Duplicate_Rows", 394.13, "Duplicate Rows: 4"),
        ("Fahrzeiten_2018_Deleting_Duplicate_Rows", 407.91, "Duplicate Rows: 1"),
        ("Fahrzeiten_2019_Deleting_Duplicate_Rows", 408.14, "Duplicate Rows: 1594"),
        ("Fahrzeiten_2020_Deleting_Duplicate_Rows", 395.13, "Duplicate Rows: 1911"),
        ("Fahrzeiten_2021_Deleting_Duplicate_Rows", 399.89, "Duplicate Rows: 8374"),
        ("Fahrzeiten_2022_Deleting_Duplicate_Rows", 397.19, "Duplicate Rows: 246"),
        ("Haltepunkte_2016_Unifying_Empty", 0.11, "Empty Cells: 4015"),
        ("Haltepunkte_2017_Unifying_Empty", 0.11, "Empty Cells: 4150"),
        ("Haltepunkte_2018_Unifying_Empty", 0.17, "Empty Cells: 6452"),
        ("Haltepunkte_2019_Unifying_Empty", 0.19, "Empty Cells: 6515"),
        ("Haltepunkte_2020_Unifying_Empty", 0.41, "Empty Cells: 6539"),
        ("Haltepunkte_2021_Unifying_Empty", 0.19, "Empty Cells: 6626"),
        ("Haltepunkte_2022_Unifying_Empty", 0.17, "Empty Cells: 6644"),
        ("Fahrzeiten_2016_Checking_Dates", 219.34, "Different Dates in Rows: 1878600; False Dates: 0"),
        ("Fahrzeiten_2017_Checking_Dates", 221.13, "Different Dates in Rows: 1840187; False Dates: 0"),
        ("Fahrzeiten_2018_Checking_Dates", 229.81, "Different Dates in Rows: 1958969; False Dates: 0"),
        ("Fahrzeiten_2019_Checking_Dates", 229.82, "Different Dates in Rows: 1951904; False Dates: 0"),
        ("Fahrzeiten_2020_Checking_Dates", 221.17, "Different Dates in Rows: 1872458; False Dates: 0"),
        ("Fahrzeiten_2021_Checking_Dates", 225.83, "Different Dates in Rows: 1881634; False Dates: 0"),
        ("Fahrzeiten_2022_Checking_Dates", 219.41, "Different Dates in Rows: 1875722; False Dates: 0"),
        ("Fahrzeiten_2016_Renaming_And_Deletion", 0.09, "True"),
        ("Fahrzeiten_Deleting_Duplicate_Rows", None, None),
    ]
    led = spark.createDataFrame(data, "process string, time double, output string")
    got = {r.process: (r.time, r.output) for r in ledger_rollup(led).collect()}
    assert got["Fahrzeiten_Deleting_Duplicate_Rows"] == (2804.37, "Duplicate Rows: 12130")
    assert got["Haltepunkte_Unifying_Empty"] == (1.35, "Empty Cells: 40941")
    assert got["Fahrzeiten_Checking_Dates"] == (1566.51, "Different Dates in Rows: 13259474; False Dates: 0")
    assert got["Fahrzeiten_Renaming_And_Deletion"] == (0.09, "True")


def test_ledger_and_step_runner(spark, tmp):
    led = Ledger(spark, f"{tmp}/ledger")
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    calls = []

    def dedup(d):
        calls.append("dedup")
        out = d.dropDuplicates()
        return StepResult(out, {"Duplicate Rows": 1}, True)

    written = []
    out = run_steps(df, [(dedup, "T_Deleting_Duplicate_Rows")], led,
                    write=lambda d: written.append(d) or d)
    assert out.count() == 2 and calls == ["dedup"] and len(written) == 1
    assert led.done("T_Deleting_Duplicate_Rows")
    run_steps(df, [(dedup, "T_Deleting_Duplicate_Rows")], led)
    assert calls == ["dedup"]  # recorded steps are skipped
    assert rows(led.pending(["T_Deleting_Duplicate_Rows", "T_Other"])) == [("T_Other",)]
    assert led.latest().first().output == "Duplicate Rows: 1"


def test_report_parse_golden(spark, tmp):
    text = "\n".join([
        "Year: 2017", "-----------------------------------",
        "halt_punkt_diva_von: 2440", "halt_punkt_diva_nach: 2598", "halt_id_von: 2728", "halt_id_nach: 2886",
        "halt_diva_von: 2728", "halt_diva_nach: 2886", "halt_kurz_von: 743104", "halt_kurz_nach: 743046",
        "-----------------------------------", "Total Time: 79.95 seconds", "==================================="])
    _write(f"{tmp}/report/counts.txt", text)
    parsed = parse_sectioned_report(read_report_lines(spark, f"{tmp}/report"), ["file"], "pos", "line")
    got = rows(parsed)
    assert len(got) == 8 and all(y == 2017 for y, _, _ in got)
    assert ("halt_kurz_von", 743104) in [(c, n) for _, c, n in got]


def test_catalog_and_canton_lookup(spark):
    df = spark.createDataFrame([("ZH",), ("ZH",), ("BE",), ("XX",), (None,)], "kanton string")
    assert [tuple(r) for r in counts_with_names(df, "kanton", canton_table(spark)).collect()] == \
        [("ZH", "Zürich", 2), ("BE", "Bern", 1)]
    prof = table_profile({"cantons": canton_table(spark)})
    assert tuple(prof.first()) == ("cantons", 4, 26)
    assert sql_source(spark, {"c": canton_table(spark)}, "SELECT count(*) AS n FROM c").first().n == 26


def test_report_render_write_parse_roundtrip(spark, tmp):
    from tramline.sources.reports import render_sectioned_report, write_report
    counts = spark.createDataFrame([(2016, "halt_id_von", 5), (2016, "halt_kurz_von", 7), (2017, "halt_id_von", 1)],
                                   "yr int, column_name string, n long")
    lines = render_sectioned_report(counts, F.lit(1), "yr", "column_name", "n", footer="Total Time: 1.5 seconds")
    write_report(lines, f"{tmp}/rep")
    back = parse_sectioned_report(read_report_lines(spark, f"{tmp}/rep"), ["file"], "pos", "line")
    assert rows(back) == [(2016, "halt_id_von", 5), (2016, "halt_kurz_von", 7), (2017, "halt_id_von", 1)]


def test_read_latest_version(spark, tmp):
    a = spark.createDataFrame([(2021, 1)], "year int, v1 int")
    b = spark.createDataFrame([(2021, 2), (2022, 3)], "year int, v1 int")
    sinks.write_versioned(a, tmp, "t", partition_by=["year"], version="20240101T000000")
    sinks.write_versioned(b, tmp, "t", partition_by=["year"], version="20240102T000000")
    assert rows(sinks.read_latest(spark, tmp, "t"), "year", "v1") == [(2021, 2), (2022, 3)]


def test_table_profile_keeps_empty_tables(spark):
    prof = table_profile({"a": spark.createDataFrame([(1, 2)], "x int, y int"),
                          "empty": spark.createDataFrame([], "x int")})
    assert rows(prof) == [("a", 2, 1), ("empty", 1, 0)]
