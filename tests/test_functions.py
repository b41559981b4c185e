import datetime as dt

from pyspark.sql import functions as F

from tramline.functions.dates import (dates_from_file_name, german_month_name, month_length, parse_dmy,
                                      weekday_index)
from tramline.functions.geo import lv95_to_bessel, lv95_to_wgs84, lv95_to_wgs84_approx
from tramline.functions.nulls import unify_empty
from tramline.functions.numbers import (decimal_comma_to_double, ends_with_zero_fraction, range_category,
                                        round_half_even, row_max, thousands)
from tramline.functions.text import capitalize, first_token, literal_replace, search_match, split_once, words


def test_parse_dmy_pivot_and_invalid(spark):
    df = spark.createDataFrame([("05.03.97",), ("05.03.16",), ("31.02.17",), ("1997-03-05",), (None,),
                                ("01.01.69",), ("31.12.68",)], "t string")
    got = [r[0] for r in df.select(parse_dmy(F.col("t"))).collect()]
    assert got == [dt.date(1997, 3, 5), dt.date(2016, 3, 5), None, None, None,
                   dt.date(1969, 1, 1), dt.date(2068, 12, 31)]


def test_lv95_origin(spark):
    df = spark.createDataFrame([(2600000.0, 1200000.0)], "e double, n double")
    lat, lon = lv95_to_wgs84_approx(F.col("e"), F.col("n"))
    r = df.select(F.round(lat, 6), F.round(lon, 6)).first()
    assert (r[0], r[1]) == (46.951081, 7.438637)


def test_lv95_published_points(spark):
    """The published examples: a point on the ellipsoid (Rigi) and one in
    WGS84, both well within a centimetre (3e-9 rad are 2 cm)."""
    def dms(d, m, s):
        return d + m / 60 + s / 3600
    df = spark.createDataFrame([(2679520.05, 1212273.44), (2700000.0, 1100000.0)], "e double, n double").coalesce(1)
    lat, lon = lv95_to_bessel(F.col("e"), F.col("n"))
    rigi = df.select(F.degrees(lat), F.degrees(lon)).first()
    assert abs(rigi[0] - dms(47, 3, 28.95659233)) < 5e-9 and abs(rigi[1] - dms(8, 29, 11.11127154)) < 5e-9
    lat, lon = lv95_to_wgs84(F.col("e"), F.col("n"))
    south = df.select(lat, lon).collect()[1]
    assert abs(south[0] - dms(46, 2, 38.87)) < 0.005 / 3600 and abs(south[1] - dms(8, 43, 49.79)) < 0.005 / 3600


def test_lv95_undoes_the_projection(spark):
    """Forward formulas in plain Python, there and back within a millimetre."""
    import math
    a, e2 = 6377397.155, 0.006674372230614
    e = math.sqrt(e2)
    p0, l0 = math.radians(46 + 57 / 60 + 8.66 / 3600), math.radians(7 + 26 / 60 + 22.5 / 3600)
    r = a * math.sqrt(1 - e2) / (1 - e2 * math.sin(p0) ** 2)
    al = math.sqrt(1 + e2 / (1 - e2) * math.cos(p0) ** 4)
    b0 = math.asin(math.sin(p0) / al)
    s = lambda p: al * math.log(math.tan(math.pi / 4 + p / 2)) - al * e / 2 * math.log((1 + e * math.sin(p)) / (1 - e * math.sin(p)))
    k = math.log(math.tan(math.pi / 4 + b0 / 2)) - s(p0)

    def forward(p, lam):
        b = 2 * (math.atan(math.exp(s(p) + k)) - math.pi / 4)
        l = al * (lam - l0)
        lb = math.atan(math.sin(l) / (math.sin(b0) * math.tan(b) + math.cos(b0) * math.cos(l)))
        bb = math.asin(math.cos(b0) * math.sin(b) - math.sin(b0) * math.cos(b) * math.cos(l))
        return 2600000 + r * lb, 1200000 + r / 2 * math.log((1 + math.sin(bb)) / (1 - math.sin(bb)))

    points = [(2480000.0 + 35000 * i, 1070000.0 + 23000 * i) for i in range(10)]
    lat, lon = lv95_to_bessel(F.col("e"), F.col("n"))
    for row in spark.createDataFrame(points, "e double, n double").select("e", "n", lat, lon).collect():
        back = forward(row[2], row[3])
        assert abs(back[0] - row[0]) < 1e-3 and abs(back[1] - row[1]) < 1e-3


def test_unify_empty_and_literal_replace(spark):
    df = spark.createDataFrame([("",), ("None",), ("Null",), ("x.y",), (None,)], "s string")
    got = [r[0] for r in df.select(unify_empty(F.col("s"))).collect()]
    assert got == [None, None, None, "x.y", None]
    got = [r[0] for r in df.select(literal_replace(F.col("s"), ".", ",")).collect()]
    assert got[3] == "x,y"  # a literal dot, not a regex wildcard


def test_split_tokens_and_capitalize(spark):
    df = spark.createDataFrame([("46.1, 7.2, x",), ("nosep",), (None,)], "s string")
    a, b = split_once(F.col("s"), ", ")
    got = df.select(a, b, first_token(F.col("s"), ","), capitalize(F.lit("hELLO"))).collect()
    assert tuple(got[0]) == ("46.1", "7.2, x", "46.1", "Hello")
    assert tuple(got[1])[:3] == ("nosep", None, "nosep")
    w = df.select(F.explode(words(F.col("s"), ",")).alias("w")).collect()
    assert [r.w for r in w] == ["46.1", "7.2", "x", "nosep"]


def test_search_match_null_is_empty_text(spark):
    df = spark.createDataFrame([("Zürich HB",), (None,)], "s string")
    assert [r[0] for r in df.select(search_match(F.col("s"), "HB")).collect()] == [True, False]
    assert [r[0] for r in df.select(search_match(F.col("s"), "HB", negate=True)).collect()] == [False, True]


def test_numbers(spark):
    df = spark.createDataFrame([(1.0, 2.5, "46,95", 5), (2.5, None, "x", 20), (None, 1.0, None, 1000)],
                               "a double, b double, s string, k int")
    got = df.select(ends_with_zero_fraction(F.col("a")), row_max(["a", "b"]), decimal_comma_to_double(F.col("s")),
                    range_category(F.col("k"), [(2, 17, "Tram"), (18, 28, "Bergbahn"), (29, 916, "Bus")], "Other"),
                    round_half_even(F.lit(2.5), 0), thousands(F.lit(1234567.0), 0, ".")).collect()
    assert [tuple(r) for r in got] == [
        (True, 2.5, 46.95, "Tram", 2.0, "1.234.567"),
        (False, 2.5, None, "Bergbahn", 2.0, "1.234.567"),
        (False, 1.0, None, "Other", 2.0, "1.234.567")]


def test_dates(spark):
    df = spark.createDataFrame([("Fahrzeiten_SOLL_IST_20220102_20220108.csv", dt.date(2024, 2, 10)),
                                ("Haltestelle.csv", dt.date(2023, 3, 1))], "f string, d date")
    s, e = dates_from_file_name(F.col("f"))
    got = df.select(s, e, german_month_name(F.col("d")), month_length(F.col("d")), weekday_index(F.col("d"))).collect()
    assert tuple(got[0]) == (dt.date(2022, 1, 2), dt.date(2022, 1, 8), "Februar", 29, 5)
    assert tuple(got[1]) == (None, None, "März", 31, 2)
