"""The timetable cleaning and audit runs on their own table shapes.

Raw files: weekly trip-segment CSVs and yearly stop / stop-point CSVs in one
directory per year (``fahrzeiten_<year>/``), a passenger-count CSV and a stop
register. Every year is handled in the same DataFrame (``jahr`` read from the
file path), so a per-year metric is one grouped aggregate instead of a loop
over years. The ledger receives one row per year and step in the usual text
format, plus the step's total row with the step's time.

Staging: the raw CSV is parsed once and written as parquet below the shared
checkpoint folder, and again after the de-duplication shuffle, so the later
metric aggregates read only their columns instead of re-parsing text and
re-shuffling.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.dates import parse_dmy
from tramline.functions.geo import lv95_to_wgs84
from tramline.functions.nulls import unify_empty
from tramline.functions.text import literal_replace, split_once, strip_grouping_dots
from tramline.operators import quality as Q
from tramline.operators import repair as R
from tramline.operators import snapshots as S
from tramline.operators.joins import fill_from_parent, key_join, lookup_fill
from tramline.operators.projection import apply_operations, drop_if_clean  # noqa: F401 (re-exported)
from tramline.session import ensure_checkpoint_dir, materialize
from tramline.sources.files import read_csv
from tramline.sources.sinks import versioned_path
from tramline.sources.ledger import Ledger, format_output

# Raw schemas of the source files (column names and types).
RAW_SCHEMAS = {
    "fahrzeiten": (
        "linie SMALLINT, richtung TINYINT, betriebsdatum STRING, fahrzeug INT, kurs SMALLINT, seq_von INT, "
        "halt_diva_von INT, halt_punkt_diva_von INT, halt_kurz_von1 STRING, datum_von STRING, soll_an_von INT, "
        "ist_an_von INT, soll_ab_von INT, ist_ab_von INT, seq_nach INT, halt_diva_nach INT, "
        "halt_punkt_diva_nach INT, halt_kurz_nach1 STRING, datum_nach STRING, soll_an_nach INT, "
        "ist_an_nach1 INT, soll_ab_nach INT, ist_ab_nach INT, fahrt_id BIGINT, fahrweg_id BIGINT, "
        "fw_no SMALLINT, fw_typ TINYINT, fw_kurz STRING, fw_lang STRING, umlauf_von BIGINT, "
        "halt_id_von BIGINT, halt_id_nach BIGINT, halt_punkt_id_von BIGINT, halt_punkt_id_nach BIGINT"),
    "haltestellen": "halt_id BIGINT, halt_diva BIGINT, halt_kurz STRING, halt_lang STRING, halt_ist_aktiv BOOLEAN",
    "haltepunkte": ("halt_punkt_id BIGINT, halt_punkt_diva BIGINT, halt_id BIGINT, GPS_Latitude STRING, "
                    "GPS_Longitude STRING, GPS_Bearing DOUBLE, halt_punkt_ist_aktiv BOOLEAN"),
    "passagierfrequenz": (
        "code_codice STRING, uic BIGINT, bahnhof_gare_stazione STRING, kt_ct_cantone STRING, isb_gi STRING, "
        "jahr_annee_anno INT, dtv_tjm_tgm DOUBLE, dwv_tmjo_tfm DOUBLE, dnwv_tmjno_tmgnl DOUBLE, evu_ef_itf STRING, "
        "bemerkungen STRING, remarques STRING, note STRING, remarks STRING, geopos STRING, lod STRING"),
    "haltestellen_liste": "Name STRING, `E-Koord.` STRING, `N-Koord.` STRING",
}

# Rename / drop operations per table.
RENAME_DROP = {
    "fahrzeiten": [
        "RENAME ist_an_nach1 TO ist_an_nach",
        "DROP halt_diva_von",
        "DROP halt_punkt_diva_von",
        "DROP halt_kurz_von1",
        "DROP halt_diva_nach",
        "DROP halt_punkt_diva_nach",
        "DROP halt_kurz_nach1",
        "DROP halt_id_von",
        "DROP halt_id_nach",
    ],
    "haltestellen": [
        "RENAME halt_id TO id",
        "RENAME halt_diva TO diva",
        "DROP halt_ist_aktiv",
    ],
    "haltepunkte": [
        "RENAME halt_punkt_id TO id",
        "RENAME halt_punkt_diva TO diva",
        "RENAME GPS_Latitude TO latitude",
        "RENAME GPS_Longitude TO longitude",
        "RENAME GPS_Bearing TO bearing",
        "RENAME halt_punkt_ist_aktiv TO ist_aktiv",
    ],
    "passagierfrequenz": [
        "RENAME code_codice TO bahnhof_kurz",
        "RENAME bahnhof_gare_stazione TO bahnhof_lang",
        "RENAME kt_ct_cantone TO kanton",
        "RENAME isb_gi TO bahnhofseigner",
        "RENAME jahr_annee_anno TO jahr",
        "RENAME dtv_tjm_tgm TO durchschnittlicher_täglicher_verkehr",
        "RENAME dwv_tmjo_tfm TO durchschnittlicher_werktäglicher_verkehr",
        "RENAME dnwv_tmjno_tmgnl TO durchschnittlicher_nicht_werktäglicher_verkehr",
        "RENAME evu_ef_itf TO einbezogene_bahnunternehmen",
    ],
}

# Value unification operations per table.
UNIFY = {
    "haltestellen": [
        "REPLACE AT halt_lang , WITH ;",
        'REPLACE AT halt_lang " WITH ',
    ],
    "haltepunkte": [
        'REPLACE AT latitude " WITH ',
        'REPLACE AT longitude " WITH ',
        "REPLACE AT latitude , WITH .",
        "REPLACE AT longitude , WITH .",
        "CHECK . IN bearing",
    ],
    "passagierfrequenz": [
        "REPLACE AT einbezogene_bahnunternehmen , WITH ;",
        'REPLACE AT einbezogene_bahnunternehmen " WITH ',
        "CHECK . IN durchschnittlicher_täglicher_verkehr",
        "CHECK . IN durchschnittlicher_werktäglicher_verkehr",
        "CHECK . IN durchschnittlicher_nicht_werktäglicher_verkehr",
    ],
}

# Keyed patch of the passenger table, column -> {uic: value}.
PASSENGER_PATCH = {
    "jahr": {8503000: 2018},
    "latitude": {8503421: 47.654404, 8509369: 46.21516, 8503420: 47.654404},
    "longitude": {8503421: 8.5733, 8509369: 10.16675, 8503420: 8.566823},
    "link": {8503421: "https://lod.opentransportdata.swiss/didok/8503421",
             8509369: "https://lod.opentransportdata.swiss/didok/8509369",
             8503420: "https://lod.opentransportdata.swiss/didok/8503420"},
}

DATE_COLS = ["betriebsdatum", "datum_von", "datum_nach"]
REMARK_COLS = ["bemerkungen", "remarques", "note", "remarks"]
YEAR_DIR = r"fahrzeiten_([0-9]{4})"
YEAR = "__year"          # year of the source directory, written as ``jahr``
POST_CAST = {"haltepunkte": {"latitude": "double", "longitude": "double"}}

# A step: frame -> (frame, metrics per year {year|None: {name: value}} or None).
Step = Callable[[DataFrame], tuple[DataFrame, dict | None]]


# ------------------------------------------------------------------ reading

def read_raw(spark: SparkSession, raw_dir: str, table: str) -> DataFrame:
    """Raw table with ``jahr`` from the year directory (all years, one scan).
    File names vary in case, so the globs accept both."""
    base = raw_dir.rstrip("/")
    schema = RAW_SCHEMAS[table]
    if table == "passagierfrequenz":
        return read_csv(spark, f"{base}/passagierfrequenz.csv", schema, sep=";")
    if table == "haltestellen_liste":
        return read_csv(spark, f"{base}/haltestellen_liste.csv", schema, sep=";")
    pattern = {"fahrzeiten": "[Ff]ahrzeiten*.csv", "haltestellen": "[Hh]altestelle.csv",
               "haltepunkte": "[Hh]altepunkt.csv"}[table]
    df = read_csv(spark, f"{base}/fahrzeiten_*/{pattern}", schema)
    year = F.regexp_extract(F.col("_metadata.file_path"), YEAR_DIR, 1).cast("int")
    return df.select(year.alias(YEAR), *[F.col(f"`{c}`") for c in df.columns])


def _years(df: DataFrame, aggs: dict[str, Column]) -> dict:
    """One grouped aggregate -> {year: {metric: value}} (None key when the
    table has no source-directory year)."""
    if YEAR not in df.columns:
        r = df.agg(*[a.alias(k) for k, a in aggs.items()]).first()
        return {None: {k: r[k] for k in aggs}}
    rows = df.groupBy(YEAR).agg(*[a.alias(k) for k, a in aggs.items()]).collect()
    return {r[YEAR]: {k: r[k] for k in aggs} for r in rows}


def _null_cells(df: DataFrame, skip=(YEAR,)) -> Column:
    """Missing cells over all columns: NULL, and NaN in floating-point
    columns (pandas ``isnull``)."""
    cells = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        c = F.col(f"`{f.name}`")
        miss = c.isNull() | F.isnan(c) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c.isNull()
        cells.append(F.count_if(miss))
    return sum(cells, F.lit(0)).cast("long")


# ------------------------------------------------------------------ raw -> clean steps

def rename_and_delete(table: str) -> Step:
    return lambda df: (apply_operations(df, RENAME_DROP[table]), None)


def delete_duplicates(df: DataFrame) -> tuple[DataFrame, dict]:
    """Global exact de-duplication (per year, as ``jahr`` is a column). The
    counts before and after come from one aggregation over the distinct rows
    with their multiplicities."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__m"))
    groups = materialize(groups, "dedup")           # with the counts, so that the metric needs no second shuffle
    dedup = groups.drop("__m")
    m = _years(groups, {"Duplicate Rows": (F.sum("__m") - F.count(F.lit(1))).cast("long")})
    return dedup, m


def unify_empty_step(df: DataFrame) -> tuple[DataFrame, dict]:
    """'', 'None', 'Null' -> NULL in text columns; report all NULL cells."""
    out = df.select(*[unify_empty(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                      else F.col(f"`{f.name}`") for f in df.schema.fields])
    return out, _years(out, {"Empty Cells": _null_cells(out)})


def unify_values(table: str) -> Step:
    """Literal replacements, then 'CHECK . IN c': narrow c to an integer when
    every value is whole (one aggregate decides, the schema depends on it)."""
    def step(df):
        ops = UNIFY.get(table, [])
        df = apply_operations(df, [o for o in ops if o.startswith("REPLACE")])
        checks = [o.split(" ")[3] for o in ops if o.startswith("CHECK")]
        for c in [c for c in checks if c in df.columns]:
            if isinstance(df.schema[c].dataType, T.StringType):
                df = df.withColumn(c, F.col(c).try_cast("double"))
        for c, t in POST_CAST.get(table, {}).items():
            df = df.withColumn(c, F.col(c).try_cast(t))
        if checks:
            df = R.narrow_integers(df, [c for c in checks if c in df.columns])
        return df, None
    return step


def change_date_format(df: DataFrame) -> tuple[DataFrame, dict]:
    """'dd.mm.yy' -> DATE; lost = non-null text that is no valid date."""
    lost = sum((F.count_if(F.col(c).isNotNull() & parse_dmy(F.col(c)).isNull()) for c in DATE_COLS), F.lit(0))
    m = _years(df, {"False Dates": lost.cast("long")})
    return df.select(*[parse_dmy(F.col(c)).alias(c) if c in DATE_COLS else F.col(c) for c in df.columns]), m


def compare_date_copies(df: DataFrame) -> tuple[DataFrame, dict]:
    """The operating day against its copies, per year; the copies go when they
    say nothing of their own."""
    found = _years(df, dict(zip(("Different Dates in Rows", "False Dates"), Q.disagreement_counts(DATE_COLS), strict=True)))
    total = df.sparkSession.createDataFrame([(sum(v["Different Dates in Rows"] for v in found.values()),)], "n long")
    return drop_if_clean(df, total, "n", DATE_COLS[1:]), found


def split_geopos(df: DataFrame) -> tuple[DataFrame, None]:
    """'lat, lon' -> latitude, longitude; lod -> link."""
    lat, lon = split_once(F.col("geopos"), ", ")
    out = df.withColumn("latitude", lat.try_cast("double")).withColumn("longitude", lon.try_cast("double")) \
            .withColumn("link", F.col("lod")).drop("geopos", "lod")
    return out, None


def check_remarks(df: DataFrame) -> tuple[DataFrame, dict]:
    """Rows with some but not all remark languages; keep one remark column
    when no row is partial."""
    m = {None: {"Inconsistent Rows": Q.partially_filled(df, REMARK_COLS).first()[0]}}
    if m[None]["Inconsistent Rows"] == 0:
        df = df.drop(*REMARK_COLS[1:])
    return df, m


def clean_steps(table: str) -> list[tuple[Step, str]]:
    """Step list per raw table (name suffixes as in the ledger)."""
    steps = [(rename_and_delete(table), "Renaming_And_Deletion"), (delete_duplicates, "Deleting_Duplicate_Rows"),
             (unify_empty_step, "Unifying_Empty")]
    if table == "fahrzeiten":
        return steps + [(change_date_format, "Changing_Date_Format"), (compare_date_copies, "Checking_Dates")]
    steps.append((unify_values(table), "Unifying_Values"))
    if table == "passagierfrequenz":
        steps += [(split_geopos, "Splitting_Geopos"), (check_remarks, "Checking_Remarks")]
    return steps


def run_yearly(df: DataFrame, table: str, steps: list[tuple[Step, str]]) -> tuple[DataFrame, list[tuple]]:
    """Run steps over all years at once; returns the frame and the ledger
    rows. Per year and step one row ('Table_2019_Step', output); per step one
    total row ('Table_Step') with the step's time and summed output."""
    title = table.capitalize()
    recorded: list[tuple] = []
    for step, name in steps:
        total = f"{title}_{name}"
        t0 = time.time()
        df, metrics = step(df)
        seconds = round(time.time() - t0, 2)
        if metrics is None:
            recorded.append((total, seconds, "True"))
            continue
        summed: dict = {}
        rows = []
        for year, vals in sorted(metrics.items(), key=lambda kv: (kv[0] is None, kv[0])):
            if year is not None:
                rows.append((f"{title}_{year}_{name}", None, format_output(vals)))
            for k, v in vals.items():
                summed[k] = summed.get(k, 0) + (v or 0)
        recorded += [*rows, (total, seconds, format_output(summed))]
    return df, recorded


def clean_table(spark: SparkSession, raw_dir: str, table: str, out_base: str, ledger: Ledger,
                version: str | None = None) -> str:
    """Raw CSV -> cleaned parquet (partitioned by year where there is one),
    written once to a new versioned path; returns the path.

    All steps or none: the steps' ledger rows are written in one go after the
    data, with the path under 'Table_Written'. If that is recorded, its path
    is returned and nothing is written; a run that stopped before starts anew."""
    ensure_checkpoint_dir(spark)
    written = f"{table.capitalize()}_Written"
    before = ledger.latest().where((F.col("process") == written) & F.col("time").isNotNull()).select("output").first()
    if before:
        return before["output"]
    t0 = time.time()
    staged = materialize(read_raw(spark, raw_dir, table), f"staged-{table}")
    df, recorded = run_yearly(staged, table, clean_steps(table))
    path = versioned_path(out_base, table, version)
    w = df.write.mode("errorifexists")
    if YEAR in df.columns:
        df = df.select(F.col(YEAR).alias("jahr"), *[F.col(f"`{c}`") for c in df.columns if c != YEAR])
        w = df.write.mode("errorifexists").partitionBy("jahr")
    w.parquet(path)
    ledger.record_many([*recorded, (written, round(time.time() - t0, 2), path)])
    return path


# ------------------------------------------------------------------ audits and repairs on cleaned tables

def check_foreign_keys_segments(segments: DataFrame, stop_points: DataFrame, offenders_path: str | None = None
                                ) -> tuple[DataFrame, str]:
    """Segments whose from / to stop point does not exist in the same year
    (Q1). Offending rows are returned (and written per year and side when a
    path is given); the segments are kept unchanged."""
    checks = [(side, stop_points, ["jahr", f"halt_punkt_id_{side}"], ["jahr", "id"]) for side in ("von", "nach")]
    offenders = Q.orphan_rows(segments, checks).drop("fk_value")
    if offenders_path:
        offenders.write.mode("errorifexists").partitionBy("jahr", "side").parquet(offenders_path)
        offenders = segments.sparkSession.read.parquet(offenders_path)
    n = offenders.count()
    return offenders, f"Foreign Keys not Existing: {n}"


def check_foreign_keys_stop_points(stop_points: DataFrame, stops: DataFrame) -> str:
    bad = key_join(stop_points, stops, [("halt_id", "id")], "left_anti")
    return f"Foreign Keys not Existing: {bad.count()}"


def put_in_correct_years(segments: DataFrame, out_path: str) -> tuple[str, bool]:
    """Re-file every segment under the year of its operating day (Q2): one
    write partitioned by the true year; returns the ledger text and whether
    anything moved."""
    moved = segments.where(F.year("betriebsdatum") != F.col("jahr")).count()
    fixed = segments.withColumn("jahr", F.coalesce(F.year("betriebsdatum"), F.col("jahr")))
    fixed.hint("rebalance", F.col("jahr")).write.mode("errorifexists").partitionBy("jahr").parquet(out_path)
    return f"Rows in Wrong Year: {moved}", moved > 0


def check_consistent_ids(snapshots: DataFrame, skip=("id", "jahr", "ist_aktiv")) -> str:
    """Cells that change between consecutive years (Q3), in the ledger's
    text: 'Inconsistent Ids: n; Columns: c: k; ...' (non-zero columns only)."""
    cols = [c for c in snapshots.columns if c not in skip]
    res = {r["column_name"]: r["inconsistent"] for r in S.changed_cells(snapshots, "id", "jahr", cols).collect()}
    nonzero = [(c, res[c]) for c in cols if res.get(c)]
    total = sum(v for _, v in nonzero)
    if total == 0:
        return "Inconsistent Ids: 0"
    return f"Inconsistent Ids: {total}; Columns: " + "; ".join(f"{c}: {v}" for c, v in nonzero)


def check_ids_in_next_year(snapshots: DataFrame) -> str:
    """'True' when every id of a year exists in the next year (Q4)."""
    missing = S.ids_missing_next_year(snapshots, "id", "jahr").limit(1).count()
    return "True" if missing == 0 else "False"


def merge_stops(snapshots: DataFrame) -> DataFrame:
    """Stops: the last year's snapshot (Q12)."""
    return S.last_year(snapshots, "jahr")


def merge_stop_points(years: dict[int, DataFrame]) -> DataFrame:
    """Stop points: all years under one another, the year in front (Q12)."""
    return S.stack_years(years)


def check_reactivated(stop_points: DataFrame) -> str:
    n = S.reactivated(stop_points, "id", "jahr", "ist_aktiv").count()
    return f"Reactivated: {n}"


def check_same_location(stop_points: DataFrame) -> str:
    r = Q.same_key_counts(stop_points, ["jahr", "latitude", "longitude"], ["bearing"],
                          ["latitude", "longitude"]).first()
    return f"Same Location: {r['same']}; Also Same Bearing: {r['also_same']}"


def add_bearing(stop_points: DataFrame) -> tuple[DataFrame, str]:
    out = R.add_sentinel_bearing(stop_points, "latitude", "longitude", "bearing", -1.0)
    return out, f"Added Bearing: {out.where(F.col('bearing') == -1).count()}"


def add_stop_coordinates(stops: DataFrame, register: DataFrame) -> tuple[DataFrame, str]:
    """Stop coordinates by name from the register (Q8): stored names use ';'
    for ',', register coordinates carry grouping dots; grid -> WGS84."""
    e = strip_grouping_dots(F.col("`E-Koord.`")).try_cast("double")
    n = strip_grouping_dots(F.col("`N-Koord.`")).try_cast("double")
    lat, lon = lv95_to_wgs84(e, n)
    reg = register.select(F.col("Name").alias("name"), lat.alias("r_lat"), lon.alias("r_lon"))
    if "latitude" not in stops.columns:
        stops = stops.withColumn("latitude", F.lit(None).cast("double")) \
                     .withColumn("longitude", F.lit(None).cast("double"))
    keyed = stops.withColumn("__name", literal_replace(F.col("halt_lang"), ";", ","))
    out = lookup_fill(keyed, reg, "__name", "name", {"latitude": "r_lat", "longitude": "r_lon"}).drop("__name")
    out = out.withColumn("halt_lang", literal_replace(literal_replace(F.col("halt_lang"), ",", ";"), '"', ""))
    return out, f"Empty Cells: {out.agg(_null_cells(out)).first()[0]}"


def add_stop_point_coordinates(stop_points: DataFrame, stops: DataFrame) -> tuple[DataFrame, str]:
    """Stop points without latitude take their stop's coordinates; bearing
    becomes -2 (Q9)."""
    parent = stops.select(F.col("id").alias("__sid"), F.col("latitude").alias("s_lat"),
                          F.col("longitude").alias("s_lon"))
    out = fill_from_parent(stop_points, parent, "halt_id", "__sid", {"latitude": "s_lat", "longitude": "s_lon"},
                           when_null="latitude", flag_col="bearing", flag_value=-2.0)
    return out, f"Empty Cells: {out.agg(_null_cells(out)).first()[0]}"


def fill_passenger_values(passengers: DataFrame) -> tuple[DataFrame, str]:
    """Keyed patch of known gaps (Q10)."""
    patches = {c: v for c, v in PASSENGER_PATCH.items() if c in passengers.columns}
    out = R.keyed_patch(passengers, "uic", patches)
    return out, f"Empty Cells: {out.agg(_null_cells(out)).first()[0]}"


# ------------------------------------------------------------------ exploration tables (chart inputs)

# Line number ranges of the line categories.
LINE_TYPES = [(2, 17, "Tram"), (18, 28, "Bergbahn"), (29, 916, "Bus")]


def line_type_counts(segments: DataFrame, line: str = "linie") -> DataFrame:
    """Distinct lines per category, 'Other' for lines outside every range
    (P7, A3, U5)."""
    from tramline.functions.numbers import range_category
    lines = segments.select(line).where(F.col(line).isNotNull()).distinct()
    cat = range_category(F.col(line), LINE_TYPES, "Other").alias("type_of_line")
    return lines.groupBy(cat).agg(F.count(F.lit(1)).alias("count"),
                                  F.sort_array(F.collect_list(F.when(cat == "Other", F.col(line)))).alias("lines"))


def top_lines(segments: DataFrame, k: int = 10, line: str = "linie") -> DataFrame:
    """Most frequent lines over all files (A1, A2, T2); k is capped by the
    number of lines automatically."""
    from tramline.operators.ordering import top_k_by
    counts = segments.where(F.col(line).isNotNull()).groupBy(line).agg(F.count(F.lit(1)).alias("count"))
    return top_k_by(counts, "count", k, [line])


def top_stops(segments: DataFrame, stops: DataFrame, k: int = 10, stop_key: str = "halt_id_von",
              stop_id: str = "halt_id", stop_name: str = "halt_lang") -> DataFrame:
    """Most frequent departure stops by name (A1, J9, T2): counted per id
    first, then joined to the names and added up per name."""
    from tramline.operators.ordering import top_k_by
    per_id = segments.groupBy(F.col(stop_key).alias("__sid")).agg(F.count(F.lit(1)).alias("count"))
    # one name per stop id (the smallest, so the choice is deterministic)
    names = stops.groupBy(F.col(stop_id).alias("__sid")).agg(F.min(stop_name).alias("stop"))
    by_name = per_id.join(names, "__sid").groupBy("stop").agg(F.sum("count").cast("long").alias("count"))
    return top_k_by(by_name, "count", k, ["stop"])


def city_counts(segments: DataFrame, stops: DataFrame, stop_keys=("halt_id_von",), stop_id: str = "halt_id",
                stop_name: str = "halt_lang", per_file: bool = False) -> DataFrame:
    """Cities (name text before the first comma) of the stops used by the
    segments (X5, J5, Q20): ``stops`` = distinct used stop names per city,
    or with ``per_file`` the number of (file, stop name) pairs, i.e. each
    name counted once per weekly file."""
    from tramline.functions.text import first_token
    used = None
    for c in stop_keys:
        cols = [F.col(c).alias("__sid")] + ([F.col("_metadata.file_name").alias("__file")] if per_file else [])
        part = segments.select(*cols)
        used = part if used is None else used.unionByName(part)
    used = used.where(F.col("__sid").isNotNull()).distinct()
    names = stops.select(F.col(stop_id).alias("__sid"), F.col(stop_name).alias("__name")).distinct()
    named = used.join(names, "__sid").drop("__sid").distinct()
    city = first_token(F.col("__name"), ",").alias("city")
    return named.groupBy(city).agg(F.count(F.lit(1)).alias("count"))


def vehicle_count(segments: DataFrame, vehicle: str = "fahrzeug") -> DataFrame:
    """Number of distinct vehicles (A3)."""
    return segments.agg(F.count_distinct(vehicle).alias("vehicles"))


def owners_vs_operators(passengers: DataFrame, owner: str = "bahnhofseigner",
                        operators: str = "einbezogene_bahnunternehmen", sep: str = ";") -> DataFrame:
    """Stations per owner and per operating company (Q19): value counts of
    the owner, value counts of the split and trimmed operator lists (A8, X6),
    combined by a full outer join with 0 for missing (J10), the larger of the
    two (P9) and the long form (P10)."""
    from tramline.functions.numbers import row_max
    from tramline.functions.text import words
    from tramline.operators.joins import combine_counts
    own = passengers.where(F.col(owner).isNotNull()).groupBy(F.col(owner).alias("company")) \
                    .agg(F.count(F.lit(1)).alias("count"))
    ops = passengers.select(F.explode(words(F.col(operators), sep)).alias("company")) \
                    .where(F.col("company").isNotNull() & (F.col("company") != "")) \
                    .groupBy("company").agg(F.count(F.lit(1)).alias("count"))
    wide = combine_counts(own, ops, "company", "owner_stations", "operator_stations")
    wide = wide.withColumn("max_count", row_max(["owner_stations", "operator_stations"]))
    return wide.unpivot(["company", "max_count"], ["owner_stations", "operator_stations"], "type", "stations")


def top_passenger_stations(passengers: DataFrame, measure: str, k: int = 10, years=(2018, 2022),
                           station: str = "bahnhof_lang", year: str = "jahr",
                           null_year_as: int | None = None) -> DataFrame:
    """All rows of the k stations with the largest maximum of ``measure`` over
    the given years (Q18, W1, T3, F2); ``null_year_as`` treats a missing year
    as that year (the second variant uses 2018)."""
    from tramline.operators.ordering import top_k_by
    p = passengers
    if null_year_as is not None:
        p = p.withColumn(year, F.coalesce(F.col(year), F.lit(null_year_as)))
    p = p.where(F.col(year).isin(*years))
    best = p.groupBy(station).agg(F.max(measure).alias("max_value"))
    top = top_k_by(best, "max_value", k, [station])
    # ``top`` holds at most k rows, so broadcasting it is bounded by k.
    return p.join(F.broadcast(top), station).select(station, year, measure, "max_value")


def canton_counts(passengers: DataFrame, canton: str = "kanton", year: str = "jahr",
                  only_year: int | None = None) -> DataFrame:
    """Stations per canton with full names (Q21), all years or one year."""
    from tramline.sources.lookups import canton_table, counts_with_names
    p = passengers if only_year is None else passengers.where(F.col(year) == only_year)
    return counts_with_names(p, canton, canton_table(passengers.sparkSession))


# ------------------------------------------------------------------ copied columns vs parents (Q14-Q16)

# (name, child column pattern, parent table, parent column) of the copies in
# a segment; ``{d}`` is the direction ('von' / 'nach').
COPY_PAIRS = [
    ("halt_diva", "halt_diva_{d}", "h", "halt_diva"),
    ("halt_punkt_diva", "halt_punkt_diva_{d}", "hp", "halt_punkt_diva"),
    ("halt_kurz", "halt_kurz_{d}1", "h", "halt_kurz"),
    ("halt_id", "halt_id_{d}", "h", "halt_id"),
]


def copy_audit_frame(segments: DataFrame, stop_points: DataFrame, stops: DataFrame) -> DataFrame:
    """Raw segments (both directions) next to the attributes of the stop
    point and stop they reference in the same year.

    Each segment is unpivoted into a 'von' and a 'nach' row first, so both
    directions go through one join of the segments with the stop points and
    one with the stops (instead of one query per direction and year).
    """
    year = YEAR if YEAR in segments.columns else "jahr"
    per_dir = []
    for d in ("von", "nach"):
        per_dir.append(F.struct(
            F.lit(d).alias("direction"), F.col(f"halt_punkt_id_{d}").alias("key_hp_id"),
            *[F.col(c.format(d=d)).cast("string").alias(f"f_{i}") for i, (_, c, _, _) in enumerate(COPY_PAIRS)]))
    rows = segments.select(F.col(year).alias("jahr"), F.explode(F.array(*per_dir)).alias("s")).select("jahr", "s.*")
    hp_year = YEAR if YEAR in stop_points.columns else "jahr"
    h_year = YEAR if YEAR in stops.columns else "jahr"
    hp = stop_points.select(F.col(hp_year).alias("__hp_j"), F.col("halt_punkt_id").alias("__hp_id"),
                            F.col("halt_id").alias("key_h_id"),
                            F.col("halt_punkt_diva").cast("string").alias("hp_halt_punkt_diva"))
    h = stops.select(F.col(h_year).alias("__h_j"), F.col("halt_id").alias("__h_id"),
                     *[F.col(p).cast("string").alias(f"h_{p}") for p in ("halt_diva", "halt_kurz", "halt_id")])
    j = rows.join(hp, (rows["jahr"] == hp["__hp_j"]) & (rows["key_hp_id"] == hp["__hp_id"]), "inner") \
            .join(h, (F.col("jahr") == h["__h_j"]) & (F.col("key_h_id") == h["__h_id"]), "inner")
    return j.drop("__hp_j", "__hp_id", "__h_j", "__h_id")


def _audit_pairs() -> list[tuple[str, str, str]]:
    return [(name, f"f_{i}", f"{table}_{p}") for i, (name, _, table, p) in enumerate(COPY_PAIRS)]


def copy_mismatch_counts(segments: DataFrame, stop_points: DataFrame, stops: DataFrame) -> DataFrame:
    """(jahr, column_name, mismatches, total_rows, percent) with
    column_name like 'halt_kurz_von' (A22, A24, A25, Q16): one aggregation
    over the joined rows; the totals are the segment rows of the year."""
    j = copy_audit_frame(segments, stop_points, stops)
    pairs = _audit_pairs()
    aggs = [F.count_if((F.col("direction") == d) & (F.col(c) != F.col(p))).alias(f"{n}_{d}")
            for n, c, p in pairs for d in ("von", "nach")]
    year = YEAR if YEAR in segments.columns else "jahr"
    totals = segments.groupBy(F.col(year).alias("jahr")).agg(F.count(F.lit(1)).alias("total_rows"))
    names = [f"{n}_{d}" for n, _, _ in pairs for d in ("von", "nach")]
    counts = j.groupBy("jahr").agg(*aggs).unpivot(["jahr"], names, "column_name", "mismatches")
    return counts.join(totals, "jahr").withColumn(
        "percent", F.round(F.col("mismatches") * 100.0 / F.col("total_rows"), 4))


def copy_mismatch_pairs(segments: DataFrame, stop_points: DataFrame, stops: DataFrame) -> DataFrame:
    """Frequency of each (copied value, parent value) mismatch per year,
    direction and column (A23, Q15)."""
    j = copy_audit_frame(segments, stop_points, stops)
    return Q.mismatch_pairs(j, _audit_pairs(), ["jahr", "direction"])


# ------------------------------------------------------------------ segment rules (Q13)

DAY = 24 * 60 * 60


def _in_day(column: str) -> tuple[str, str, str]:
    return "time of day", f"{column} lies within its day", f"{column} BETWEEN 0 AND {DAY - 1}"


def _in_order(first: str, then: str) -> tuple[str, str, str]:
    return "order of times", f"{first} comes no later than {then}", f"{first} <= {then}"


def _not_over(name: str) -> tuple[str, str, str]:
    return "beyond midnight", f"{name} at both stops ends with the day", f"{name}_von < {DAY} AND {name}_nach < {DAY}"


def _not_under(name: str) -> tuple[str, str, str]:
    return "before the day", f"{name} at both stops is not negative", f"{name}_von >= 0 AND {name}_nach >= 0"


#: (family, rule, what a valid row satisfies)
SEGMENT_RULES = [
    ("single", "the direction is 1 or 2", "richtung IN (1, 2)"),
    ("single", "the trip does not end before its day", "datum_von <= datum_nach"),
    ("single", "the stops follow each other", "seq_von + 1 = seq_nach"),
    *[_in_day(f"soll_an_{stop}") for stop in ("von", "nach")],
    *[_in_order(f"{kind}_an_{stop}", f"{kind}_ab_{stop}") for kind in ("ist", "soll") for stop in ("von", "nach")],
]
#: Rules whose violations are counted.
SEGMENT_COUNT_RULES = [*[_not_over(name) for name in ("ist_an", "ist_ab", "soll_ab")], *[_not_under(name) for name in ("ist_an", "ist_ab")]]


def check_segment_rules(segments: DataFrame) -> DataFrame:
    """(family, rule, violations, all_pass) for every pass rule and counted
    rule, all evaluated in one aggregation over the cleaned segments (every
    failing rule is reported, not only the first of a family)."""
    return Q.rule_violations(segments, SEGMENT_RULES + SEGMENT_COUNT_RULES)
