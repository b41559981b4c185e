"""Registered queries over operators that write and read back (CSV files,
period tables, page indexes) or change the columns of a table, and over a
station table in the shape of the passenger statistics. Same contract as
``tramline.plans.driver``; the oracle SQL is in ``runs_oracle``.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.numbers import round_half_even
from tramline.operators import projection as P
from tramline.operators import quality as Q
from tramline.operators import repair as R
from tramline.operators import snapshots as S
from tramline.operators.aggregates import group_count, unique_profile
from tramline.operators.describe import describe_columns
from tramline.operators.joins import composite_consistency
from tramline.operators.paging import PageIndex
from tramline.plans import timetable as TT
from tramline.plans.tables import audit_frame, every, load, snapshots
from tramline.session import materialize, scratch_path
from tramline.sources.catalog import sql_source
from tramline.sources.files import header_columns, pick_separator, read_csv, rejected_cells, rejected_counts, with_decimal_comma
from tramline.sources.ledger import Ledger, StepResult, run_steps
from tramline.sources.lookups import CANTONS
from tramline.sources.periods import PeriodTable
from tramline.sources.sinks import read_latest, write_single_file, write_versioned


# ------------------------------------------------------------------ cells that do not fit

ORDER_TYPES = "o_orderkey bigint, o_custkey tinyint, o_totalprice double, o_orderdate date, o_orderstatus string"


def _order_text(spark, d):
    """orders as text cells: prices 'n/a', a date with month 13, statuses of
    any text; customer keys beyond a tinyint are there anyway."""
    o = load(spark, d, "orders")
    k = "o_orderkey"
    text = lambda c: F.col(c).cast("string")
    return o.select(text(k).alias(k), text("o_custkey").alias("o_custkey"),
                    F.when(every(k, 31), F.lit("n/a")).otherwise(text("o_totalprice")).alias("o_totalprice"),
                    F.when(every(k, 37), F.lit("1997-13-01")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
                    F.when(every(k, 41), F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))


def rejected_cell_counts(spark, d):
    """Cells per column that have none of the declared type."""
    typed = P.conform(_order_text(spark, d), T.StructType.fromDDL(ORDER_TYPES), rescue="lost")
    return rejected_counts(typed, "lost")


def csv_rescued(spark, d):
    """The same cells with their texts, after a trip through CSV files
    (S1, S2, S5, S6): every cell that a plain read would turn into NULL."""
    path = scratch_path(spark, "orders-csv")
    _order_text(spark, d).write.option("header", True).csv(path)
    back = read_csv(spark, [f"{path}/*.csv"], ORDER_TYPES, rescue="lost")
    return rejected_cells(back, "lost", ["o_orderkey"])


def csv_typed(spark, d):
    """Typed columns of the CSV files, some of them only."""
    path = scratch_path(spark, "orders-csv")
    _order_text(spark, d).write.option("header", True).csv(path)
    return read_csv(spark, path, ORDER_TYPES, columns=["o_orderkey", "o_custkey", "o_totalprice"], rescue="lost").drop("lost")


def decimal_comma(spark, d):
    """Prices written '1234,5' as numbers (S4), the measure rounded half to
    even (X16); a cell with two commas is none."""
    o = load(spark, d, "orders")
    euro = F.translate(F.col("o_totalprice").cast("string"), ".", ",")
    t = o.select("o_orderkey", F.when(every("o_orderkey", 29), F.concat(F.lit("1,"), euro)).otherwise(euro).alias("price"))
    t = with_decimal_comma(t, ["price"])
    return t.select("o_orderkey", "price", round_half_even(F.col("o_orderkey") / 2, 0).alias("half"))


# ------------------------------------------------------------------ whole tables

def dedup_rows(spark, d):
    """Whole rows de-duplicated (A16): line items without their numbers."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
    return Q.dedup_exact(li.unionByName(li.where(every("l_orderkey", 3))))


def describe_table(spark, d):
    """All numeric columns of lineitem described in the same passes."""
    return describe_columns(load(spark, d, "lineitem"))


def unique_profile_joined(spark, d):
    """Distinct values per column of a joined frame, in one pass over it (A3, A4)."""
    return unique_profile(audit_frame(spark, d), one_pass=True)


def narrowed_columns(spark, d):
    """Columns whose every value is whole, cast to integers."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return R.narrow_integers(li, ["l_quantity", "l_tax"])


def shaped_columns(spark, d):
    """The column list of a cleaning step (P1, P1b, P2, P4, X1): rename,
    drop, replace, keep, a leading constant; absent columns are skipped."""
    c = P.apply_operations(load(spark, d, "customer"), [
        "RENAME c_name TO name", "RENAME absent TO other", "REPLACE AT name Customer#0000 WITH C", "DROP c_acctbal", "DROP absent"])
    return P.with_leading_constant(P.keep_columns(c, ["c_custkey", "name", "c_mktsegment", "absent"]), "jahr", 2022)


def dropped_if_clean(spark, d):
    """A copy of the order date goes when no row disagrees with it, another
    one with disagreeing rows stays (P3)."""
    od = F.to_date("o_orderdate")
    o = load(spark, d, "orders").select("o_orderkey", od.alias("day"), od.alias("same_day"),
                                        F.date_add(od, (F.col("o_orderkey") % 97 == 0).cast("int")).alias("other_day"))
    for copy in ("same_day", "other_day"):
        o = P.drop_if_clean(o, Q.date_disagreement(o, ["day", copy]), "different_dates", [copy])
    return o


def sql_over_frames(spark, d):
    """SQL text over named frames."""
    return sql_source(spark, {"runs_nation": load(spark, d, "nation"), "runs_region": load(spark, d, "region")},
                      "SELECT r_name, count(*) AS nations FROM runs_nation JOIN runs_region ON n_regionkey = r_regionkey GROUP BY r_name")


def composite_pairs(spark, d):
    """Pairs of copied columns per key against their dictionary."""
    t = audit_frame(spark, d).select("l_orderkey", F.col("f_custkey").alias("o_custkey"), F.col("f_orderstatus").alias("o_orderstatus"))
    ref = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    return composite_consistency(t, ref, "l_orderkey", ["o_custkey", "o_orderstatus"])


# ------------------------------------------------------------------ periods, pages, snapshots

def refiled_rows(spark, d):
    """Orders filed under a wrong year, filed anew (Q2): every moved row with
    its old and new folder, read from the new version."""
    o = load(spark, d, "orders")
    day = F.to_date("o_orderdate")
    filed = F.when(every("o_orderkey", 10), F.year(F.date_sub(day, 30))).otherwise(F.year(day))
    table = PeriodTable(spark, scratch_path(spark, "filed"), "orders", "jahr")
    table.write(o.select("o_orderkey", day.alias("day"), filed.alias("was_filed"), filed.alias("jahr")))
    table.refile(F.year("day"))
    now = table.read()
    return now.where(F.col("jahr") != F.col("was_filed")).select("o_orderkey", "was_filed", F.col("jahr").alias("new_year"))


def page_deep(spark, d):
    """A page in the middle of the orders by price (F11), from an index."""
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    index = PageIndex.build(o, ["o_totalprice", "o_orderkey"], scratch_path(spark, "page-index"))
    return index.page(index.n_rows // 50, 25)


def snapshot_last_year(spark, d):
    """Stops: the last year's rows (Q12)."""
    return S.last_year(snapshots(spark, d), "jahr")


def snapshot_union(spark, d):
    """Stop points: yearly tables of different columns under one another, the
    year in front (Q12, P2, U1)."""
    s = snapshots(spark, d)
    years = {y: s.where(F.col("jahr") == y).select("id", "label", *(["aktiv"] if y > 1994 else [])) for y in range(1992, 1999)}
    return TT.merge_stop_points(years)


def merge_decision(spark, d):
    """The gate with the run ledger (Q11): the merge of the region's name has
    been run where the region's key is even."""
    r = load(spark, d, "region")
    ledger = r.select(F.concat("r_name", F.lit("_Csv_Merging")).alias("process"),
                      F.when(F.col("r_regionkey") % 2 == 0, 1.5).alias("time"))
    snap = snapshots(spark, d).where(F.col("jahr") >= 1997)
    gates = [S.merge_gate(snap, "id", "jahr", keys, ledger, f"{name}_Csv_Merging").select(F.lit(name).alias("table_name"), "*")
             for name, keys in (("AFRICA", ["grp"]), ("AMERICA", ["grp", "label"]))]
    return gates[0].unionByName(gates[1])


def patched_from_table(spark, d):
    """Customers patched from a table of corrections (Q10), the suppliers of
    the same number: balances of some, segments of others cleared."""
    c = load(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    k = F.col("s_suppkey")
    patch = load(spark, d, "supplier").select(
        k.alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"), F.lit(None).cast("string").alias("c_mktsegment"),
        F.when(k % 3 == 0, F.array(F.lit("c_acctbal"))).when(k % 3 == 1, F.array(F.lit("c_mktsegment")))
        .otherwise(F.array().cast("array<string>")).alias("cells"))
    return R.patch_from_table(c, "c_custkey", patch)


# ------------------------------------------------------------------ sinks, steps

def versioned_rows(spark, d):
    """Two versions of a table, partitioned by year; readers see the newer."""
    o = load(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("yr"))
    base = scratch_path(spark, "versions")
    write_versioned(o, base, "orders", partition_by=["yr"], version="20240101T000000000")
    write_versioned(o.where(~every("o_orderkey", 3)), base, "orders", partition_by=["yr"], version="20240102T000000000")
    return read_latest(spark, base, "orders")


def single_file_rows(spark, d):
    """One CSV file, written by all tasks and joined by its bytes (S10), read
    with the separator and columns its header gives (S3, S7)."""
    p = load(spark, d, "part").select("p_partkey", "p_name", "p_size")
    path = write_single_file(p, scratch_path(spark, "single-file"), order_by=["p_partkey"])
    sep = pick_separator(spark, path, p.columns)
    return read_csv(spark, path, "p_partkey bigint, p_name string, p_size int", sep=sep, columns=header_columns(spark, path, sep))


def step_ledger(spark, d):
    """Cleaning steps with their ledger (S18, Q25, D4): all run once, the
    second run finds them recorded and changes nothing."""
    def deduplicate(df):
        r = Q.dedup_counts(df).first()
        return StepResult(Q.dedup_exact(df), {"Duplicate Rows": r["duplicates_removed"]}, True)

    def drop_small(df):
        return StepResult(df.where(F.col("l_quantity") >= 2), {"Small Rows": df.where(F.col("l_quantity") < 2).count()}, True)

    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    steps = [(deduplicate, "Lineitem_Deleting_Duplicate_Rows"), (drop_small, "Lineitem_Dropping_Small_Rows")]
    table = run_steps(li.unionByName(li.where(every("l_orderkey", 5))), steps, ledger, lambda df: materialize(df, "steps"))
    again = run_steps(table, steps, ledger)
    rows = ledger.rows().select("process", "output")
    return rows.unionByName(again.agg(F.concat(F.lit("Rows: "), F.count(F.lit(1)).cast("string")).alias("output"))
                            .select(F.lit("Lineitem").alias("process"), "output"))


def mapped_batches(spark, d):
    """A user's function over Arrow batches (D1): words of a part's name, capitalised."""
    p = load(spark, d, "part").select("p_partkey", "p_name")
    return P.map_batches(p, lambda pdf: pdf.assign(p_name=pdf["p_name"].str.upper()), p.schema)


# ------------------------------------------------------------------ stations

def _stations(spark, d):
    """Customers as stations: name, year (some missing), measure, canton,
    owner, and a list of companies."""
    c = load(spark, d, "customer")
    k = F.col("c_custkey")
    codes = F.array(*[F.lit(x[0]) for x in sorted(CANTONS)])
    return c.select(
        F.concat(F.lit("S"), (k % 40).cast("string")).alias("bahnhof_lang"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.lit(2018) + 2 * (k % 3)).cast("int").alias("jahr"),
        F.col("c_acctbal").alias("verkehr"),
        F.when(k % 11 == 0, F.lit("XX")).when(k % 13 == 0, F.lit(None)).otherwise(
            F.element_at(codes, (F.col("c_nationkey") + 1).cast("int"))).alias("kanton"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("bahnhofseigner"),
        F.when(k % 3 == 0, F.concat(F.col("c_mktsegment"), F.lit("; EXTRA;"))).otherwise(F.col("c_mktsegment")).alias("einbezogene_bahnunternehmen"))


def owner_operator_counts(spark, d):
    """Stations per owner and per company of the lists (Q19)."""
    return TT.owners_vs_operators(_stations(spark, d))


def top_stations_null_year(spark, d):
    """All rows of the busiest stations, a missing year taken as 2018 (Q18)."""
    return TT.top_passenger_stations(_stations(spark, d), "verkehr", 5, null_year_as=2018)


def stations_per_canton(spark, d):
    """Stations per canton with its full name."""
    return TT.canton_counts(_stations(spark, d))


def share_per_canton(spark, d):
    """Share of each canton's stations that name an owner."""
    s = _stations(spark, d).where(F.col("kanton").isNotNull())
    named = group_count(s.where(F.col("bahnhofseigner").isNotNull()), "kanton", "named")
    return Q.share_of_total(named, group_count(s, "kanton", "stations"), ["kanton"], "named", "stations")


QUERIES = {
    "rejected_cell_counts": rejected_cell_counts,
    "csv_rescued": csv_rescued,
    "csv_typed": csv_typed,
    "decimal_comma": decimal_comma,
    "dedup_rows": dedup_rows,
    "describe_table": describe_table,
    "unique_profile_joined": unique_profile_joined,
    "narrowed_columns": narrowed_columns,
    "shaped_columns": shaped_columns,
    "dropped_if_clean": dropped_if_clean,
    "sql_over_frames": sql_over_frames,
    "composite_pairs": composite_pairs,
    "refiled_rows": refiled_rows,
    "page_deep": page_deep,
    "snapshot_last_year": snapshot_last_year,
    "snapshot_union": snapshot_union,
    "merge_decision": merge_decision,
    "patched_from_table": patched_from_table,
    "versioned_rows": versioned_rows,
    "single_file_rows": single_file_rows,
    "step_ledger": step_ledger,
    "mapped_batches": mapped_batches,
    "owner_operator_counts": owner_operator_counts,
    "top_stations_null_year": top_stations_null_year,
    "stations_per_canton": stations_per_canton,
    "share_per_canton": share_per_canton,
}
