"""The timetable cleaning and audit runs on a small hand-made raw layout."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tramline.plans import timetable as TT
from tramline.sources.ledger import Ledger, ledger_rollup

FZ_COLS = [c.split(" ")[0] for c in TT.RAW_SCHEMAS["fahrzeiten"].split(", ")]


def _fz_row(linie, datum, hp_von, hp_nach, fw_kurz="S1", datum_von=None, datum_nach=None, soll=100):
    v = {c: "" for c in FZ_COLS}
    v.update(linie=str(linie), richtung="1", betriebsdatum=datum, fahrzeug="7", kurs="1", seq_von="1",
             datum_von=datum_von or datum, datum_nach=datum_nach or datum, soll_an_von=str(soll),
             seq_nach="2", fw_kurz=fw_kurz, halt_punkt_id_von=str(hp_von), halt_punkt_id_nach=str(hp_nach),
             fahrt_id="1", umlauf_von="5")
    return ",".join(v[c] for c in FZ_COLS)


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def raw():
    d = tempfile.mkdtemp(prefix="tramline-raw-")
    head = ",".join(FZ_COLS)
    # 2021: one exact duplicate, a 'None' cell, an impossible date, one row of 2020, an unknown stop point
    _write(f"{d}/fahrzeiten_2021/Fahrzeiten_SOLL_IST_20210103_20210109.csv", [
        head, _fz_row(2, "04.01.21", 10, 11), _fz_row(2, "04.01.21", 10, 11), _fz_row(3, "05.01.21", 11, 99, "None"),
        _fz_row(4, "31.12.20", 10, 11)])
    _write(f"{d}/fahrzeiten_2021/fahrzeiten_SOLL_IST_20210110_20210116.csv", [
        head, _fz_row(5, "31.02.21", 10, 11), _fz_row(6, "11.01.21", 10, 11, datum_nach="12.01.21")])
    _write(f"{d}/fahrzeiten_2022/Fahrzeiten_SOLL_IST_20220102_20220108.csv", [head, _fz_row(7, "03.01.22", 10, 12)])
    for y, rows_hs, rows_hp in [
        (2021, ["1,100,ZUE,\"Zürich, HB\",True", "2,200,BER,Bern,True"],
         ["10,1000,1,\"47,378\",\"8,540\",90.0,True", "11,1100,1,\"47,378\",\"8,540\",,False",
          "12,1200,2,,,,True"]),
        (2022, ["1,100,ZHB,\"Zürich, HB\",True", "2,200,BER,Bern,True"],
         ["10,1000,1,\"47,378\",\"8,540\",90.0,True", "11,1100,1,\"47,378\",\"8,540\",,True",
          "12,1200,2,,,,True"])]:
        _write(f"{d}/fahrzeiten_{y}/Haltestelle.csv", ["halt_id,halt_diva,halt_kurz,halt_lang,halt_ist_aktiv"] + rows_hs)
        _write(f"{d}/fahrzeiten_{y}/Haltepunkt.csv",
               ["halt_punkt_id,halt_punkt_diva,halt_id,GPS_Latitude,GPS_Longitude,GPS_Bearing,halt_punkt_ist_aktiv"]
               + rows_hp)
    pf_head = ("code_codice;uic;bahnhof_gare_stazione;kt_ct_cantone;isb_gi;jahr_annee_anno;dtv_tjm_tgm;dwv_tmjo_tfm;"
               "dnwv_tmjno_tmgnl;evu_ef_itf;bemerkungen;remarques;note;remarks;geopos;lod")
    _write(f"{d}/passagierfrequenz.csv", [
        pf_head,
        "ZUE;8503000;Zürich HB;ZH;RAILA;;450000.0;480000.0;400000.0;RAILA, RAILB;;;;;47.378, 8.540;https://x/8503000",
        "BER;8507000;Bern;BE;RAILA;2022;200000.0;210000.0;150000.0;RAILA;a;b;c;d;46.949, 7.439;https://x/8507000"])
    _write(f"{d}/haltestellen_liste.csv", ["Name;E-Koord.;N-Koord.", "Zürich, HB;2.683.184;1.248.067"])
    return d


def test_clean_fahrzeiten_ledger_and_output(spark, raw):
    tmp = tempfile.mkdtemp(prefix="tramline-out-")
    led = Ledger(spark, f"{tmp}/ledger")
    path = TT.clean_table(spark, raw, "fahrzeiten", f"{tmp}/clean", led, version="1")
    out = {r.process: r.output for r in led.latest().collect()}
    assert out["Fahrzeiten_2021_Deleting_Duplicate_Rows"] == "Duplicate Rows: 1"
    assert out["Fahrzeiten_2022_Deleting_Duplicate_Rows"] == "Duplicate Rows: 0"
    assert out["Fahrzeiten_Deleting_Duplicate_Rows"] == "Duplicate Rows: 1"
    assert out["Fahrzeiten_2021_Changing_Date_Format"] == "False Dates: 3"    # 31.02.21 in three date columns
    assert out["Fahrzeiten_2021_Checking_Dates"] == "Different Dates in Rows: 1; False Dates: 1"
    assert out["Fahrzeiten_Renaming_And_Deletion"] == "True"
    rolled = {r.process: r.output for r in ledger_rollup(led.rows()).collect()}
    assert rolled["Fahrzeiten_Deleting_Duplicate_Rows"] == "Duplicate Rows: 1"
    clean = spark.read.parquet(path)
    assert clean.count() == 6
    assert "ist_an_nach" in clean.columns and "halt_id_von" not in clean.columns
    assert clean.where("fw_kurz IS NULL").count() == 1
    assert dict(clean.dtypes)["betriebsdatum"] == "date"
    # a second run writes nothing and names the version that is there
    before = led.rows().count()
    assert TT.clean_table(spark, raw, "fahrzeiten", f"{tmp}/clean", led, version="2") == path
    assert led.rows().count() == before
    assert not os.path.exists(f"{tmp}/clean/fahrzeiten/v=2")


def test_stopped_run_starts_anew(spark, raw, monkeypatch):
    tmp = tempfile.mkdtemp(prefix="tramline-out-")
    want = sorted(map(str, spark.read.parquet(TT.clean_table(
        spark, raw, "haltestellen", f"{tmp}/a", Ledger(spark, f"{tmp}/ledger-a"), version="1")).collect()))
    led, steps = Ledger(spark, f"{tmp}/ledger-b"), TT.clean_steps("haltestellen")

    def stop(df):
        raise RuntimeError("stopped")

    for n in range(len(steps)):
        with monkeypatch.context() as m:
            m.setattr(TT, "clean_steps", lambda table, n=n: [*steps[:n], (stop, steps[n][1])])
            with pytest.raises(RuntimeError):
                TT.clean_table(spark, raw, "haltestellen", f"{tmp}/b", led, version=f"s{n}")
        assert led.rows().count() == 0
    path = TT.clean_table(spark, raw, "haltestellen", f"{tmp}/b", led, version="2")
    assert sorted(map(str, spark.read.parquet(path).collect())) == want


def test_clean_stops_points_passengers(spark, raw):
    tmp = tempfile.mkdtemp(prefix="tramline-out-")
    led = Ledger(spark, f"{tmp}/ledger")
    hs = spark.read.parquet(TT.clean_table(spark, raw, "haltestellen", f"{tmp}/clean", led, version="1"))
    hp = spark.read.parquet(TT.clean_table(spark, raw, "haltepunkte", f"{tmp}/clean", led, version="1"))
    pf = spark.read.parquet(TT.clean_table(spark, raw, "passagierfrequenz", f"{tmp}/clean", led, version="1"))
    assert set(hs.columns) == {"jahr", "id", "diva", "halt_kurz", "halt_lang"}
    assert hs.where("halt_lang = 'Zürich; HB'").count() == 2
    assert "jahr" in hp.columns and dict(hp.dtypes)["latitude"] == "double"
    assert dict(hp.dtypes)["bearing"] == "double"           # a NULL bearing blocks narrowing
    assert dict(pf.dtypes)["durchschnittlicher_täglicher_verkehr"] == "bigint"
    assert set(pf.columns) >= {"latitude", "longitude", "link", "bemerkungen"}
    out = {r.process: r.output for r in led.latest().collect()}
    assert out["Haltepunkte_2021_Unifying_Empty"] == "Empty Cells: 4"
    assert out["Passagierfrequenz_Checking_Remarks"] == "Inconsistent Rows: 0"
    assert "remarques" not in pf.columns

    # audits on the cleaned yearly snapshots
    assert TT.check_consistent_ids(hs) == "Inconsistent Ids: 1; Columns: halt_kurz: 1"
    assert TT.check_ids_in_next_year(hs) == "True"
    assert TT.check_reactivated(hp) == "Reactivated: 1"
    assert TT.check_same_location(hp) == "Same Location: 4; Also Same Bearing: 0"
    stops = TT.merge_stops(hs)
    assert stops.count() == 2 and "jahr" not in stops.columns
    assert TT.check_foreign_keys_stop_points(hp, stops) == "Foreign Keys not Existing: 0"
    hp2, msg = TT.add_bearing(hp)
    assert msg == "Added Bearing: 2"
    reg = TT.read_raw(spark, raw, "haltestellen_liste")
    stops2, msg = TT.add_stop_coordinates(stops, reg)
    zh = stops2.where("id = 1").first()
    assert round(zh.latitude, 2) == 47.38 and round(zh.longitude, 2) == 8.54 and zh.halt_lang == "Zürich; HB"
    hp3, msg = TT.add_stop_point_coordinates(hp2, stops2)
    assert hp3.where("id = 12 AND bearing = -2").count() == 2
    pf2, msg = TT.fill_passenger_values(pf)
    assert pf2.where("uic = 8503000").first().jahr == 2018


def test_segment_audits(spark, raw):
    tmp = tempfile.mkdtemp(prefix="tramline-out-")
    led = Ledger(spark, f"{tmp}/ledger")
    fz = spark.read.parquet(TT.clean_table(spark, raw, "fahrzeiten", f"{tmp}/clean", led, version="1"))
    hp = spark.read.parquet(TT.clean_table(spark, raw, "haltepunkte", f"{tmp}/clean", led, version="1"))
    offenders, msg = TT.check_foreign_keys_segments(fz, hp, f"{tmp}/invalid")
    assert msg == "Foreign Keys not Existing: 1"
    assert offenders.where(F.col("side") == "nach").count() == 1
    text, changed = TT.put_in_correct_years(fz, f"{tmp}/refiled")
    assert (text, changed) == ("Rows in Wrong Year: 1", True)
    refiled = spark.read.parquet(f"{tmp}/refiled")
    assert sorted(r.jahr for r in refiled.select("jahr").distinct().collect()) == [2020, 2021, 2022]
    again, changed = TT.put_in_correct_years(refiled, f"{tmp}/refiled2")
    assert (again, changed) == ("Rows in Wrong Year: 0", False)   # idempotent


def test_exploration_tables(spark, raw):
    fz = TT.read_raw(spark, raw, "fahrzeiten")
    hs = TT.read_raw(spark, raw, "haltestellen")
    # halt_id_von / halt_id_nach are empty in the fixture: give them stop ids
    fz = fz.withColumn("halt_id_von", F.when(F.col("linie") % 2 == 0, 1).otherwise(2).cast("long"))
    types = {r.type_of_line: (r["count"], list(r.lines)) for r in TT.line_type_counts(fz).collect()}
    assert types["Tram"][0] == 6 and "Other" not in types
    top = TT.top_lines(fz, 3).collect()
    assert [(r.linie, r["count"]) for r in top] == [(2, 2), (3, 1), (4, 1)]
    stops = TT.top_stops(fz, hs, 5).collect()
    assert [(r.stop, r["count"]) for r in stops] == [("Zürich, HB", 4), ("Bern", 3)]
    cities = {r.city: r["count"] for r in TT.city_counts(fz, hs).collect()}
    assert cities == {"Zürich": 1, "Bern": 1}
    per_file = {r.city: r["count"] for r in TT.city_counts(fz, hs, per_file=True).collect()}
    assert per_file == {"Zürich": 2, "Bern": 3}
    assert TT.vehicle_count(fz).first().vehicles == 1


def test_passenger_tables(spark, raw):
    pf = TT.read_raw(spark, raw, "passagierfrequenz")
    pf = TT.apply_operations(pf, TT.RENAME_DROP["passagierfrequenz"])
    ov = {(r.company, r.type): r.stations for r in TT.owners_vs_operators(pf, sep=",").collect()}
    assert ov[("RAILA", "owner_stations")] == 2 and ov[("RAILA", "operator_stations")] == 2
    assert ov[("RAILB", "owner_stations")] == 0 and ov[("RAILB", "operator_stations")] == 1
    top = TT.top_passenger_stations(pf, "durchschnittlicher_täglicher_verkehr", k=1)
    assert [r.bahnhof_lang for r in top.collect()] == ["Bern"]          # Zürich has no year
    top2 = TT.top_passenger_stations(pf, "durchschnittlicher_täglicher_verkehr", k=1, null_year_as=2018)
    assert [r.bahnhof_lang for r in top2.collect()] == ["Zürich HB"]
    assert [tuple(r) for r in TT.canton_counts(pf).collect()] == [("BE", "Bern", 1), ("ZH", "Zürich", 1)]


def test_copy_audit(spark, raw):
    fz = TT.read_raw(spark, raw, "fahrzeiten")
    hp = TT.read_raw(spark, raw, "haltepunkte")
    hs = TT.read_raw(spark, raw, "haltestellen")
    # copies in the segments: stop point 10 -> stop 1 (diva 100, ZUE in 2021 / ZHB in 2022)
    fz = (fz.withColumn("halt_punkt_diva_von", F.when(F.col("halt_punkt_id_von") == 10, 1000).otherwise(1100))
            .withColumn("halt_diva_von", F.lit(100)).withColumn("halt_id_von", F.lit(1).cast("long"))
            .withColumn("halt_kurz_von1", F.lit("ZUE")))
    counts = {(r.jahr, r.column_name): (r.mismatches, r.total_rows) for r in TT.copy_mismatch_counts(fz, hp, hs).collect()}
    assert counts[(2021, "halt_kurz_von")] == (0, 6)
    assert counts[(2022, "halt_kurz_von")] == (1, 1)             # the stop was renamed to ZHB in 2022
    assert counts[(2021, "halt_punkt_diva_von")] == (0, 6)
    pairs = {(r.jahr, r.direction, r.column_name, r.child_value, r.parent_value): r.n
             for r in TT.copy_mismatch_pairs(fz, hp, hs).collect()}
    assert pairs[(2022, "von", "halt_kurz", "ZUE", "ZHB")] == 1


def test_command_line(spark, raw, capsys):
    from tramline.__main__ import main
    tmp = tempfile.mkdtemp(prefix="tramline-cli-")
    assert main(["clean", "--raw", raw, "--out", f"{tmp}/clean", "--ledger", f"{tmp}/ledger",
                 "--tables", "haltestellen"]) == 0
    assert main(["rollup", "--ledger", f"{tmp}/ledger"]) == 0
    out = capsys.readouterr().out
    assert "Haltestellen_Deleting_Duplicate_Rows,0.0,Duplicate Rows: 0" in out


def test_segment_rules(spark):
    import datetime as dt
    d = dt.date(2022, 1, 3)
    rows = [(1, d, d, 1, 2, 100, 200, 110, 210, 120, 220, 130, 230),
            (3, d, dt.date(2022, 1, 2), 1, 3, 90000, 200, 110, 210, -5, 220, 130, 230)]
    seg = spark.createDataFrame(rows, "richtung int, datum_von date, datum_nach date, seq_von int, seq_nach int, "
                                      "soll_an_von int, soll_an_nach int, soll_ab_von int, soll_ab_nach int, "
                                      "ist_an_von int, ist_an_nach int, ist_ab_von int, ist_ab_nach int")
    res = {r.rule: r.violations for r in TT.check_segment_rules(seg).collect()}
    assert res["the direction is 1 or 2"] == 1
    assert res["the trip does not end before its day"] == 1
    assert res["the stops follow each other"] == 1
    assert res["soll_an_von lies within its day"] == 1
    assert res["soll_an_von comes no later than soll_ab_von"] == 1
    assert res["ist_an at both stops is not negative"] == 1
    assert res["ist_an_von comes no later than ist_ab_von"] == 0


def test_command_line_stream(spark, raw):
    from tramline.__main__ import main
    tmp = tempfile.mkdtemp(prefix="tramline-cli-stream-")
    assert main(["stream", "--source", f"{raw}/fahrzeiten_2021", "--out", f"{tmp}/out",
                 "--ledger", f"{tmp}/ledger", "--checkpoint", f"{tmp}/ckpt"]) == 0
    out = spark.read.parquet(f"{tmp}/out")
    assert out.count() == 6                               # both weekly files of 2021, duplicates kept
    assert dict(out.dtypes)["betriebsdatum"] == "date"
    assert Ledger(spark, f"{tmp}/ledger").rows().count() >= 1
