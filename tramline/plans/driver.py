"""The registered queries: the library's operators applied to the driver
tables. Each function takes (spark, sf_dir) and returns a lazy DataFrame whose
column names match the oracle SQL in ``tramline.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions.dates import dates_from_file_name, parse_dmy
from tramline.functions.geo import lv95_to_wgs84
from tramline.functions.nulls import unify_empty
from tramline.functions.numbers import range_category, row_max
from tramline.functions.text import capitalize, first_token, literal_replace, split_once, \
    strip_grouping_dots, words
from tramline.operators import aggregates as A
from tramline.operators import quality as Q
from tramline.operators import repair as R
from tramline.operators import snapshots as S
from tramline.operators import timegrid as G
from tramline.operators.describe import describe as describe_op
from tramline.operators.filters import date_text_mismatch, hash_sample as hash_sample_op, search as search_op
from tramline.operators.joins import combine_counts, composite_consistency, fill_from_parent, lookup_fill, semi
from tramline.operators.ordering import attach_group_agg, page as page_op, top_k_by, with_row_number
from tramline.operators.projection import unpivot
from tramline.plans.runs import QUERIES as RUNS
from tramline.plans.tables import AUDIT_PAIRS, TABLES, audit_frame, date_text, dirty_customer, \
    every, grid_coordinates, load, snapshots, year_ranges
from tramline.sources.ledger import ledger_rollup as ledger_rollup_op
from tramline.sources.reports import parse_sectioned_report, render_sectioned_report

# ------------------------------------------------------------------ calendar

def daily_counts(spark, d):
    o = load(spark, d, "orders")
    return A.group_count(o.select(F.to_date("o_orderdate").alias("day")), "day")


def month_day_rollup(spark, d):
    return A.date_rollup(load(spark, d, "orders"), "o_orderdate")


def weekday_counts(spark, d):
    return A.weekday_totals(load(spark, d, "orders"), "o_orderdate")


def weekday_weekend_series(spark, d):
    return A.daily_series(load(spark, d, "orders"), "o_orderdate")


def day_counts_in_month(spark, d):
    o = load(spark, d, "orders")
    jan = o.where((F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
                  & (F.col("o_orderdate") < F.lit("1997-02-01").cast("timestamp_ntz")))
    return A.group_count(jan.select(F.dayofmonth("o_orderdate").alias("dom")), "dom")


# ------------------------------------------------------------------ top-k

def top_k_keys(spark, d):
    li = load(spark, d, "lineitem")
    return top_k_by(A.group_count(li, "l_suppkey"), "n", 10, ["l_suppkey"])


def top_k_named(spark, d):
    li = load(spark, d, "lineitem")
    per_part = A.group_count(li, "l_partkey")          # reduce before the lookup
    part = load(spark, d, "part").select("p_partkey", "p_name")
    named = per_part.join(part, per_part["l_partkey"] == part["p_partkey"], "inner")
    by_name = named.groupBy("p_name").agg(F.sum("n").cast("long").alias("n"))
    return top_k_by(by_name, "n", 10, ["p_name"])


def top_k_groups_all_rows(spark, d):
    o = load(spark, d, "orders").where(year_ranges("o_orderdate", [1996, 1998]))
    o = o.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr"), "o_totalprice")
    groups = o.groupBy("o_custkey").agg(F.max("o_totalprice").alias("group_max"))
    top = top_k_by(groups, "group_max", 5, ["o_custkey"])
    # ``top`` holds exactly k rows, so broadcasting it is bounded by k.
    return o.join(F.broadcast(top), "o_custkey", "inner") \
        .select("o_orderkey", "o_custkey", "yr", "o_totalprice", "group_max")


def category_bucket(spark, d):
    p = load(spark, d, "part")
    ranges = [(2, 17, "Tram"), (18, 28, "Bergbahn"), (29, 916, "Bus")]
    g = A.group_count(p, "p_size", "n_parts")
    return g.select("p_size", range_category(F.col("p_size"), ranges, "Other").alias("category"), "n_parts")


# ------------------------------------------------------------------ profiles

def distinct_counts(spark, d):
    return A.distinct_counts(load(spark, d, "lineitem"))


def unique_profile(spark, d):
    return A.unique_profile(load(spark, d, "orders"))


def empty_profile(spark, d):
    return A.empty_profile(dirty_customer(spark, d))


def empty_profile_split(spark, d):
    c = dirty_customer(spark, d)
    return A.empty_profile_split(c, F.col("c_acctbal") > 0)


def empty_total(spark, d):
    return A.empty_total(dirty_customer(spark, d))


def value_counts_two_sources(spark, d):
    cust = A.group_count(load(spark, d, "customer").withColumnRenamed("c_nationkey", "n_nationkey"),
                         "n_nationkey", "count")
    supp = A.group_count(load(spark, d, "supplier").withColumnRenamed("s_nationkey", "n_nationkey"),
                         "n_nationkey", "count")
    wide = combine_counts(cust, supp, "n_nationkey", "customers", "suppliers")
    wide = wide.withColumn("max_count", row_max(["customers", "suppliers"]))
    return unpivot(wide, ["n_nationkey", "max_count"], ["customers", "suppliers"], "source", "n")


def split_explode_counts(spark, d):
    p = load(spark, d, "part")
    w = p.select(F.explode(words(F.col("p_name"), " ")).alias("word"))
    return A.value_counts(w, "word")


def first_token_counts(spark, d):
    p = load(spark, d, "part")
    used = semi(p, load(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey")), "p_partkey")
    return A.group_count(used.select(first_token(F.col("p_name"), " ").alias("token")), "token", "n_parts")


def lookup_label_counts(spark, d):
    c = load(spark, d, "customer")
    per_nation = A.group_count(c, "c_nationkey")
    nation, region = load(spark, d, "nation"), load(spark, d, "region")
    j = per_nation.join(nation, per_nation["c_nationkey"] == nation["n_nationkey"], "inner") \
                  .join(region, nation["n_regionkey"] == region["r_regionkey"], "inner")
    return j.select("r_name", "n_name", "n")


def active_share(spark, d):
    o = load(spark, d, "orders")
    return A.boolean_share(o, F.col("o_orderstatus") == "F").select(
        F.col("n_true").alias("n_active"), F.col("n_false").alias("n_inactive"),
        F.col("pct_true").alias("active_pct"))


# ------------------------------------------------------------------ rules

# (family, rule, predicate a valid row satisfies). Shared with the oracle.
LINEITEM_RULES = [
    ("Ungrouped", "linenumber between 1 and 7", "l_linenumber BETWEEN 1 AND 7"),
    ("Ungrouped", "returnflag is R, A or N", "l_returnflag IN ('R', 'A', 'N')"),
    ("Ungrouped", "ships on or after the order date", "l_shipdate >= o_orderdate"),
    ("Between", "quantity between 1 and 50", "l_quantity BETWEEN 1 AND 50"),
    ("Between", "discount between 0 and 0.1", "l_discount BETWEEN 0 AND 0.1"),
    ("Less or equal", "tax at most 0.08", "l_tax <= 0.08"),
    ("Less or equal", "discount at most tax", "l_discount <= l_tax"),
]

EVENT_RULES = [
    ("Between 0 and 86399", "second of day in range", "sec_of_day BETWEEN 0 AND 86399"),
    ("Ungrouped", "value not negative", "value >= 0"),
    ("Ungrouped", "known event type",
     "event_type IN ('signup', 'view', 'click', 'purchase', 'error')"),
    ("Less or equal", "value at most 250", "value <= 250"),
]


def rule_violations(spark, d):
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return Q.rule_violations(j, LINEITEM_RULES)


def rule_flags(spark, d):
    e = load(spark, d, "events")
    ts = F.col("ts")
    e = e.withColumn("sec_of_day", F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))
    return Q.rule_violations(e, EVENT_RULES).select("family", "rule", "all_pass")


# ------------------------------------------------------------------ duplicates

LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]


def dedup_exact(spark, d):
    return Q.dedup_exact(load(spark, d, "lineitem").select(*LI_KEYS))


def dedup_counts(spark, d):
    return Q.dedup_counts(load(spark, d, "lineitem").select(*LI_KEYS))


def duplicate_subset(spark, d):
    li = load(spark, d, "lineitem").select(*LI_KEYS, "l_partkey", "l_suppkey")
    return Q.duplicate_rows(li, LI_KEYS)


def repeats_after_first(spark, d):
    li = load(spark, d, "lineitem")
    return Q.repeats_after_first(li, LI_KEYS, LI_ORDER).select(*LI_KEYS, "l_partkey", "l_suppkey")


def same_location(spark, d):
    c = load(spark, d, "customer").select(
        "c_nationkey", "c_mktsegment", F.floor(F.col("c_acctbal") / 100).alias("bal_band"),
        (F.col("c_custkey") % 3).alias("c_mod3"))
    return Q.same_key_counts(c, ["c_nationkey", "c_mktsegment", "bal_band"], ["c_mod3"],
                             ["c_nationkey", "c_mktsegment", "bal_band"],
                             names=("same_location", "also_same"))


def dedup_text(spark, d):
    docs = load(spark, d, "documents")
    # Grouped by a 256-bit digest and the length: the texts themselves are
    # never shuffled, only (digest, smallest row) pairs after map-side
    # combining.
    key = [F.sha2(F.col("text"), 256).alias("__h"), F.length("text").alias("__l")]
    kept = (docs.groupBy(*key)
            .agg(F.min(F.struct("doc_id", "lang", "n_chars")).alias("__k")))
    return kept.select("__k.doc_id", "__k.lang", "__k.n_chars")


# ------------------------------------------------------------------ values

def sentinel_to_null(spark, d):
    p = load(spark, d, "part")
    k = "p_partkey"
    dirty = (F.when(every(k, 9), F.lit("None")).when(every(k, 10), F.lit(""))
             .when(every(k, 11), F.lit("Null")).otherwise(F.col("p_brand")))
    return p.select(k, unify_empty(dirty).alias("p_brand"))


def literal_replace_q(spark, d):
    c = load(spark, d, "customer")
    return c.select("c_custkey", literal_replace(F.col("c_name"), "Customer#", "C.").alias("c_name"))


def narrow_integers(spark, d):
    li = load(spark, d, "lineitem")
    return R.narrowable(li, ["l_quantity", "l_extendedprice", "l_tax"])


def split_pair(spark, d):
    c = load(spark, d, "customer")
    s = F.concat_ws(", ", F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"))
    head, rest = split_once(s, ", ")
    return c.select("c_custkey", head.alias("first"), rest.alias("second"))


def parse_dates_coerce(spark, d):
    t = date_text(spark, d)
    return t.select("o_orderkey", "date_text", parse_dmy(F.col("date_text")).alias("parsed"))


def parse_dates_lost(spark, d):
    t = parse_dates_coerce(spark, d)
    return t.agg(F.count("date_text").alias("text_dates"), F.count("parsed").alias("valid_dates"),
                 (F.count("date_text") - F.count("parsed")).alias("false_dates"))


def suffix_filter(spark, d):
    t = date_text(spark, d)
    return t.where(~F.col("date_text").like("%.97"))


def regex_date_check(spark, d):
    t = date_text(spark, d)
    return t.where(F.col("date_text").isNotNull() & date_text_mismatch(F.col("date_text")))


def date_consistency(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    od = F.to_date("o_orderdate")
    k = F.col("l_orderkey")
    j = j.select(od.alias("betriebsdatum"),
                 F.date_add(od, (F.col("l_linenumber") % 2).cast("int")).alias("datum_von"),
                 F.when(k % 23 == 0, F.lit(None).cast("date"))
                  .otherwise(F.date_add(od, F.when(k % 3 == 0, 1).otherwise(0))).alias("datum_nach"))
    return Q.date_disagreement(j, ["betriebsdatum", "datum_von", "datum_nach"])


def partial_fill_rows(spark, d):
    c = load(spark, d, "customer")
    k = "c_custkey"
    t = c.select(
        F.when(every(k, 5), F.lit(None)).otherwise(F.col("c_name")).alias("a"),
        F.when(every(k, 7), F.lit("")).otherwise(F.col("c_mktsegment")).alias("b"),
        F.when(every(k, 11), F.lit(None)).otherwise(F.col("c_nationkey").cast("string")).alias("c"),
        F.when(every(k, 13), F.lit("")).otherwise(F.col("c_acctbal").cast("string")).alias("e"))
    return Q.partially_filled(t, ["a", "b", "c", "e"])


# ------------------------------------------------------------------ foreign keys

def fk_orphans(spark, d):
    li = load(spark, d, "lineitem")
    supp = load(spark, d, "supplier").where(F.col("s_acctbal") > 0)
    part = load(spark, d, "part").where(F.col("p_size") > 3)
    return Q.orphan_rows(li, [("supplier", supp, "l_suppkey", "s_suppkey"),
                              ("part", part, "l_partkey", "p_partkey")],
                         keep=["l_orderkey", "l_linenumber"], period=F.year("l_shipdate"))


def fk_check(spark, d):
    return Q.orphan_counts(fk_orphans(spark, d), ["period", "side"])


def orphan_reappears(spark, d):
    """A yearly register: a parent missing in the key check is entered in the
    years from 1994 + key % 4 on, any other one in every year."""
    def register(side, name, key, known):
        first = F.when(known, 1992).otherwise(1994 + F.col(key) % 4).cast("int")
        return load(spark, d, name).select(F.lit(side).alias("side"), F.col(key).alias("fk_value"),
                                           F.explode(F.sequence(first, F.lit(1997))).alias("period"))
    parents = (register("supplier", "supplier", "s_suppkey", F.col("s_acctbal") > 0)
               .unionByName(register("part", "part", "p_partkey", F.col("p_size") > 3)))
    return Q.orphans_reappear(fk_orphans(spark, d), parents, ["side", "fk_value"])


# ------------------------------------------------------------------ periods

def _filed_orders(spark, d):
    o = load(spark, d, "orders")
    filed = F.when(every("o_orderkey", 10), F.year(F.date_sub(F.to_date("o_orderdate"), 30))) \
             .otherwise(F.year("o_orderdate"))
    return o.select("o_orderkey", "o_orderdate", filed.alias("file_year"))


def wrong_period_rows(spark, d):
    chk = R.period_check(_filed_orders(spark, d), "o_orderdate", "file_year")
    return chk.where("wrong_period").groupBy("file_year", "true_year") \
              .agg(F.count(F.lit(1)).alias("n"))


def repartitioned(spark, d):
    chk = R.period_check(_filed_orders(spark, d), "o_orderdate", "file_year")
    return A.group_count(chk.select(F.col("true_year").alias("yr")), "yr")


# ------------------------------------------------------------------ snapshots

SNAP_COLS = ["label", "grp"]


def snapshot_consistency(spark, d):
    return S.changed_cells(snapshots(spark, d), "id", "jahr", SNAP_COLS)


def ids_next_year(spark, d):
    m = S.ids_missing_next_year(snapshots(spark, d), "id", "jahr")
    return A.group_count(m, "jahr", "missing")


def reactivated(spark, d):
    r = S.reactivated(snapshots(spark, d), "id", "jahr", "aktiv")
    return A.group_count(r, "jahr", "reactivated")


def snapshot_merge(spark, d):
    return S.latest_snapshot(snapshots(spark, d), "id", "jahr")


def merge_gate(spark, d):
    return S.merge_gate(snapshots(spark, d), "id", "jahr", ["grp"]).drop("unmerged")


# ------------------------------------------------------------------ repairs

def _located_customers(spark, d):
    c = load(spark, d, "customer")
    k = "c_custkey"
    return c.select(
        k, "c_nationkey",
        F.when(every(k, 7), F.lit(None)).otherwise(F.col("c_acctbal")).alias("latitude"),
        F.when(every(k, 11), F.lit(None)).otherwise(F.col("c_nationkey").cast("double")).alias("longitude"),
        F.when(every(k, 3), F.lit(None)).otherwise((F.col(k) % 360).cast("double")).alias("bearing"))


def sentinel_fill(spark, d):
    c = _located_customers(spark, d)
    return R.add_sentinel_bearing(c, "latitude", "longitude", "bearing").drop("c_nationkey")


def _register(spark, d):
    """Stop register: name + grid coordinates as dotted text. It covers the
    nations of the first four regions, so the others find no entry."""
    n = load(spark, d, "nation").where(F.col("n_regionkey") < 4)
    e = F.lit(2600000) + F.col("n_nationkey") * 10000 + F.col("n_regionkey") * 100
    no = F.lit(1200000) + F.col("n_regionkey") * 20000 + F.col("n_nationkey") * 500
    et, nt = grid_coordinates(e, no)
    return n.select(F.col("n_name").alias("name"), F.col("n_nationkey"), et.alias("e_koord"), nt.alias("n_koord"))


def fill_by_name(spark, d):
    reg = _register(spark, d)
    lat, lon = lv95_to_wgs84(strip_grouping_dots(F.col("e_koord")).cast("double"),
                             strip_grouping_dots(F.col("n_koord")).cast("double"))
    reg = reg.select("name", lat.alias("r_lat"), lon.alias("r_lon"))
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, d, "nation").select("n_nationkey", "n_name")
    # The child stores the name with ';' for ' ' (as the source files do);
    # it is normalised before the lookup.
    child = c.join(nation, c["c_nationkey"] == nation["n_nationkey"], "inner") \
             .select("c_custkey", F.replace(F.col("n_name"), F.lit(" "), F.lit(";")).alias("stop_name"))
    child = child.withColumn("lookup_name", F.replace(F.col("stop_name"), F.lit(";"), F.lit(" "))) \
                 .withColumn("latitude", F.lit(None).cast("double")) \
                 .withColumn("longitude", F.lit(None).cast("double"))
    filled = lookup_fill(child, reg, "lookup_name", "name", {"latitude": "r_lat", "longitude": "r_lon"})
    return filled.select("c_custkey", F.round("latitude", 6).alias("latitude"),
                         F.round("longitude", 6).alias("longitude"))


def fill_by_fk(spark, d):
    c = _located_customers(spark, d)
    reg = _register(spark, d)
    lat, lon = lv95_to_wgs84(strip_grouping_dots(F.col("e_koord")).cast("double"),
                             strip_grouping_dots(F.col("n_koord")).cast("double"))
    parent = reg.select("n_nationkey",
                        F.when(F.col("n_nationkey") % 6 == 0, F.lit(None)).otherwise(lat).alias("p_lat"),
                        lon.alias("p_lon"))
    filled = fill_from_parent(c, parent, "c_nationkey", "n_nationkey",
                              {"latitude": "p_lat", "longitude": "p_lon"}, when_null="latitude",
                              flag_col="bearing", flag_value=-2.0)
    return filled.select("c_custkey", F.round("latitude", 6).alias("latitude"),
                         F.round("longitude", 6).alias("longitude"), "bearing")


# Fixed patch (a user parameter of the keyed patch operator).
PATCHES = {"c_acctbal": {1: 0.0, 2: 100.5, 3: -1.0},
           "c_mktsegment": {2: "PATCHED", 5: None}}


def keyed_patch(spark, d):
    c = load(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return R.keyed_patch(c, "c_custkey", PATCHES)


# ------------------------------------------------------------------ audit

def denorm_audit(spark, d):
    j = audit_frame(spark, d)
    return Q.mismatch_rows(j, AUDIT_PAIRS, ["l_orderkey", "l_linenumber", "yr"])


def mismatch_counts(spark, d):
    return Q.mismatch_counts(audit_frame(spark, d), AUDIT_PAIRS, ["yr"])


def mismatch_pairs(spark, d):
    return Q.mismatch_pairs(audit_frame(spark, d), AUDIT_PAIRS, ["yr"])


def mismatch_share(spark, d):
    """Mismatches per (filed year, column) with percent of the year's child
    rows (A24, A25, J4, Q16). Some children have no parent (the orders of
    every 29th key are missing): they match nothing, but the year's total
    counts them, as it counts all rows of the year's file. One left join and
    one aggregation give both counts and totals."""
    j = audit_frame(spark, d, how="left", missing_orders=29)
    known = F.col("o_orderkey").isNotNull()
    aggs = [F.count_if(known & ~F.col(c).eqNullSafe(F.col(p))).alias(n) for n, c, p in AUDIT_PAIRS]
    wide = j.groupBy("file_year").agg(F.count(F.lit(1)).alias("total_rows"), *aggs)
    long = wide.unpivot(["file_year", "total_rows"], [n for n, _, _ in AUDIT_PAIRS], "column_name", "mismatches")
    return long.select(F.col("file_year").alias("yr"), "column_name", "mismatches", "total_rows",
                       F.round(F.col("mismatches") * 100.0 / F.col("total_rows"), 4).alias("percent"))


def composite_lookup(spark, d):
    j = audit_frame(spark, d).select("l_orderkey", F.col("f_custkey").alias("o_custkey"))
    ref = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    t = composite_consistency(j, ref, "l_orderkey", ["o_custkey"])
    return t.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(~F.col("consistent")).alias("n_inconsistent"))


# ------------------------------------------------------------------ time grid

STEP = 300  # five-minute grid


def missing_timestamps_summary(spark, d):
    return G.missing_summary(load(spark, d, "events"), "ts", STEP)


def missing_timestamps_hour(spark, d):
    return G.missing_by(load(spark, d, "events"), "ts", STEP, "hour")


def missing_timestamps_weekday(spark, d):
    return G.missing_by(load(spark, d, "events"), "ts", STEP, "weekday")


def missing_timestamps_month(spark, d):
    return G.missing_by(load(spark, d, "events"), "ts", STEP, "month")


def grid_fill(spark, d):
    return G.grid_fill_counts(load(spark, d, "events"), "ts", STEP, "event_type", "value")


# ------------------------------------------------------------------ browsing

def search(spark, d):
    p = load(spark, d, "part").select("p_partkey", "p_name", "p_type")
    return search_op(p, [("p_name", "blue|red", False), ("p_type", "^S", False)])


def search_not(spark, d):
    p = load(spark, d, "part").select("p_partkey", "p_name")
    return search_op(p, [("p_name", "ring", True)])


def page(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return page_op(o, ["o_orderkey"], 3, 10)


def describe(spark, d):
    return describe_op(load(spark, d, "orders"), "o_totalprice")


def hash_sample(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    return hash_sample_op(o, "o_orderkey", 10)


def row_ids(spark, d):
    start = load(spark, d, "nation").agg(F.max("n_nationkey")).first()[0] + 1
    s = load(spark, d, "supplier").select("s_suppkey", "s_name")
    return with_row_number(s, ["s_suppkey"], "row_id", start=start)


def table_profile(spark, d):
    from tramline.sources.catalog import table_profile as tp
    return tp({t: load(spark, d, t) for t in TABLES})


def group_max_rows(spark, d):
    """Each order with the maximum price of its customer."""
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return attach_group_agg(o, ["o_custkey"], F.max("o_totalprice"), "group_max")


# ------------------------------------------------------------------ ledger, reports, files

def ledger_rows(spark, d):
    """Per-year ledger rows produced by two cleaning checks on lineitem
    (duplicate keys, date disagreement), in the ledger's text format."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    yr = F.year("l_shipdate").alias("yr")
    g = li.groupBy(yr, *LI_KEYS).agg(F.count(F.lit(1)).alias("m"))
    dups = g.groupBy("yr").agg((F.sum("m") - F.count(F.lit(1))).alias("dups"))
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    dd = j.groupBy(F.year("l_shipdate").alias("yr")).agg(
        F.count_if(F.to_date("l_shipdate") != F.to_date("o_orderdate")).alias("diff"),
        F.count_if(F.col("l_shipdate").isNull() | F.col("o_orderdate").isNull()).alias("false"))
    a = dups.select(F.concat(F.lit("Lineitem_"), F.col("yr").cast("string"),
                             F.lit("_Deleting_Duplicate_Rows")).alias("process"),
                    F.lit(None).cast("double").alias("time"),
                    F.concat(F.lit("Duplicate Rows: "), F.col("dups").cast("string")).alias("output"))
    b = dd.select(F.concat(F.lit("Lineitem_"), F.col("yr").cast("string"),
                           F.lit("_Checking_Dates")).alias("process"),
                  F.lit(None).cast("double").alias("time"),
                  F.concat(F.lit("Different Dates in Rows: "), F.col("diff").cast("string"),
                           F.lit("; False Dates: "), F.col("false").cast("string")).alias("output"))
    return a.unionByName(b)


def ledger_rollup(spark, d):
    return ledger_rollup_op(ledger_rows(spark, d))


def report_lines(spark, d):
    """A sectioned text report rendered from the mismatch counts, one file per
    decade, with a time line whose value is no integer."""
    mc = mismatch_counts(spark, d)
    return render_sectioned_report(mc, (F.col("yr") / 10).cast("int"), "yr", "column_name", "mismatches",
                                   footer="Total Time: 76.84 seconds")


def report_parse(spark, d):
    return parse_sectioned_report(report_lines(spark, d), ["file"], "pos", "line")


def file_name_dates(spark, d):
    o = load(spark, d, "orders")
    week = F.to_date(F.date_trunc("week", F.col("o_orderdate")))
    weeks = o.select(week.alias("ws")).distinct()
    names = weeks.select(F.concat(F.lit("fahrzeiten_SOLL_IST_"), F.date_format("ws", "yyyyMMdd"), F.lit("_"),
                                  F.date_format(F.date_add("ws", 6), "yyyyMMdd"), F.lit(".csv"))
                         .alias("file_name"))
    start, end = dates_from_file_name(F.col("file_name"))
    return names.select(F.concat(capitalize(F.split_part(F.col("file_name"), F.lit("_"), F.lit(1))),
                                 F.lit("_"), F.regexp_replace("file_name", "^[^_]*_", "")).alias("file_name"),
                        start.alias("week_start"), end.alias("week_end"))


def grid_to_wgs84(spark, d):
    c = load(spark, d, "customer")
    e = F.lit(2480000) + (F.col("c_custkey") * 37) % 350000
    n = F.lit(1070000) + (F.col("c_custkey") * 53) % 220000
    et, nt = grid_coordinates(e, n)
    lat, lon = lv95_to_wgs84(strip_grouping_dots(et).cast("double"), strip_grouping_dots(nt).cast("double"))
    return c.select("c_custkey", F.round(lat, 6).alias("latitude"), F.round(lon, 6).alias("longitude"))


def key_set_ops(spark, d):
    """Customers ordering in 1996 vs 1997 as key sets: union, intersection
    and difference (U3, U4, U5), each counted."""
    from tramline.operators import setops as U
    o = load(spark, d, "orders")
    a = o.where(year_ranges("o_orderdate", [1996])).select("o_custkey")
    b = o.where(year_ranges("o_orderdate", [1997])).select("o_custkey")
    parts = [(name, df.agg(F.count(F.lit(1)).alias("n")))
             for name, df in [("union", U.union_distinct(a, b)), ("intersect", U.intersect(a, b)),
                              ("difference", U.difference(a, b))]]
    out = None
    for name, df in parts:
        df = df.select(F.lit(name).alias("op"), "n")
        out = df if out is None else out.unionByName(df)
    return out


def monthly_counts_named(spark, d):
    """Orders per (year, month) with the German month name, the month's
    length and the count with thousands separators (X9, X12, X13)."""
    from tramline.functions.dates import german_month_name, month_length
    from tramline.functions.numbers import thousands
    o = load(spark, d, "orders").select(F.to_date("o_orderdate").alias("d"))
    g = o.groupBy(F.year("d").alias("yr"), F.month("d").alias("mon")).agg(
        F.count(F.lit(1)).alias("n"), F.min("d").alias("__d"))
    return g.select("yr", "mon", german_month_name(F.col("__d")).alias("monat"),
                    month_length(F.col("__d")).alias("days"), "n",
                    thousands(F.col("n"), 0, ",").alias("n_text"),
                    thousands(F.col("n") * 1000, 0, ".").alias("n_thousands_dot"))


QUERIES = {
    "daily_counts": daily_counts,
    "month_day_rollup": month_day_rollup,
    "weekday_counts": weekday_counts,
    "weekday_weekend_series": weekday_weekend_series,
    "day_counts_in_month": day_counts_in_month,
    "top_k_keys": top_k_keys,
    "top_k_named": top_k_named,
    "top_k_groups_all_rows": top_k_groups_all_rows,
    "category_bucket": category_bucket,
    "distinct_counts": distinct_counts,
    "unique_profile": unique_profile,
    "empty_profile": empty_profile,
    "empty_profile_split": empty_profile_split,
    "empty_total": empty_total,
    "value_counts_two_sources": value_counts_two_sources,
    "split_explode_counts": split_explode_counts,
    "first_token_counts": first_token_counts,
    "lookup_label_counts": lookup_label_counts,
    "active_share": active_share,
    "rule_violations": rule_violations,
    "rule_flags": rule_flags,
    "dedup_exact": dedup_exact,
    "dedup_counts": dedup_counts,
    "duplicate_subset": duplicate_subset,
    "repeats_after_first": repeats_after_first,
    "same_location": same_location,
    "dedup_text": dedup_text,
    "sentinel_to_null": sentinel_to_null,
    "literal_replace": literal_replace_q,
    "narrow_integers": narrow_integers,
    "split_pair": split_pair,
    "parse_dates_coerce": parse_dates_coerce,
    "parse_dates_lost": parse_dates_lost,
    "suffix_filter": suffix_filter,
    "regex_date_check": regex_date_check,
    "date_consistency": date_consistency,
    "partial_fill_rows": partial_fill_rows,
    "fk_check": fk_check,
    "fk_orphans": fk_orphans,
    "orphan_reappears": orphan_reappears,
    "wrong_period_rows": wrong_period_rows,
    "repartitioned": repartitioned,
    "snapshot_consistency": snapshot_consistency,
    "ids_next_year": ids_next_year,
    "reactivated": reactivated,
    "snapshot_merge": snapshot_merge,
    "merge_gate": merge_gate,
    "sentinel_fill": sentinel_fill,
    "fill_by_name": fill_by_name,
    "fill_by_fk": fill_by_fk,
    "keyed_patch": keyed_patch,
    "denorm_audit": denorm_audit,
    "mismatch_counts": mismatch_counts,
    "mismatch_pairs": mismatch_pairs,
    "mismatch_share": mismatch_share,
    "composite_lookup": composite_lookup,
    "missing_timestamps_summary": missing_timestamps_summary,
    "missing_timestamps_hour": missing_timestamps_hour,
    "missing_timestamps_weekday": missing_timestamps_weekday,
    "missing_timestamps_month": missing_timestamps_month,
    "grid_fill": grid_fill,
    "search": search,
    "search_not": search_not,
    "page": page,
    "describe": describe,
    "hash_sample": hash_sample,
    "row_ids": row_ids,
    "table_profile": table_profile,
    "group_max_rows": group_max_rows,
    "ledger_rollup": ledger_rollup,
    "report_parse": report_parse,
    "file_name_dates": file_name_dates,
    "grid_to_wgs84": grid_to_wgs84,
    "key_set_ops": key_set_ops,
    "monthly_counts_named": monthly_counts_named,
    **RUNS,
}
