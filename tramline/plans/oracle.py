"""DuckDB SQL equivalents of the registered queries.

Each statement runs on the driver tables registered as views and returns the
same column names (and types, via explicit casts) as the Spark plan of the
same key. Dirt recipes are written as the same key rules as in
``tramline.plans.tables``.
"""

from __future__ import annotations

from tramline.plans.runs_oracle import ORACLE_SQL as RUNS_SQL

D = "CAST(100.0 AS DOUBLE)"


def _empty(col: str, text: bool) -> str:
    return f"({col} IS NULL OR {col} = '')" if text else f"({col} IS NULL)"


DIRTY_CUSTOMER = """
c AS (SELECT c_custkey,
             CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END AS c_name,
             c_nationkey,
             CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
             CASE WHEN s IN ('', 'None', 'Null') THEN NULL ELSE s END AS c_mktsegment
      FROM (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN NULL
                           WHEN c_custkey % 13 = 0 THEN 'None' ELSE c_mktsegment END AS s
            FROM customer))"""
CUST_COLS = [("c_custkey", False), ("c_name", True), ("c_nationkey", False),
             ("c_acctbal", False), ("c_mktsegment", True)]

DATE_TEXT = """
t AS (SELECT o_orderkey,
             CASE WHEN o_orderkey % 17 = 0 THEN '31.02.' || strftime(o_orderdate, '%y')
                  WHEN o_orderkey % 19 = 0 THEN NULL
                  WHEN o_orderkey % 23 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                  ELSE strftime(o_orderdate, '%d.%m.%y') END AS date_text
      FROM orders)"""

PARSED = DATE_TEXT + """,
pd AS (SELECT o_orderkey, date_text,
              CASE WHEN regexp_full_match(date_text, '[0-9]{2}\\.[0-9]{2}\\.[0-9]{2}')
                   THEN CAST(try_strptime(substr(date_text, 1, 6)
                            || CASE WHEN CAST(substr(date_text, 7, 2) AS INTEGER) >= 69 THEN '19' ELSE '20' END
                            || substr(date_text, 7, 2), '%d.%m.%Y') AS DATE) END AS parsed
       FROM t)"""

ORPHANS = """
orph AS (
  SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS period,
         'supplier' AS side, l_suppkey AS fk_value
  FROM lineitem
  WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 0 AND s_suppkey = l_suppkey)
  UNION ALL
  SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER), 'part', l_partkey
  FROM lineitem
  WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_size > 3 AND p_partkey = l_partkey))"""

SNAP = """
b AS (SELECT DISTINCT o_custkey AS id, CAST(year(o_orderdate) AS INTEGER) AS jahr FROM orders),
s AS (SELECT id, jahr,
             CASE WHEN id % 13 = jahr % 13 THEN 'L' || CAST(jahr AS VARCHAR)
                  ELSE 'L' || CAST(id % 4 AS VARCHAR) END AS label,
             CASE WHEN id % 17 = jahr % 17 THEN NULL ELSE id % 5 END AS grp,
             (id + jahr) % 5 <> 0 AS aktiv
      FROM b),
p AS (SELECT x.label AS lx, y.label AS ly, x.grp AS gx, y.grp AS gy
      FROM s x JOIN s y ON x.id = y.id AND x.jahr + 1 = y.jahr),
chg AS (SELECT 'label' AS column_name, count_if(lx IS DISTINCT FROM ly) AS inconsistent FROM p
        UNION ALL
        SELECT 'grp', count_if(gx IS DISTINCT FROM gy) FROM p),
miss AS (SELECT x.id, x.jahr FROM s x
         WHERE x.jahr < (SELECT max(jahr) FROM s)
           AND NOT EXISTS (SELECT 1 FROM s y WHERE y.id = x.id AND y.jahr = x.jahr + 1))"""

LOCATED = """
lc AS (SELECT c_custkey, c_nationkey,
              CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS latitude,
              CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_nationkey AS DOUBLE) END AS longitude,
              CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 360 AS DOUBLE) END AS bearing
       FROM customer)"""

def _wgs84(source: str) -> str:
    """``source`` (a subquery with grid coordinates e, n) with lat and lon:
    the projection's formulas step by step, the ellipsoid by iteration."""
    deg = "{} + {} / 60.0 + {} / 3600.0"
    steps = [
        ("*, 6377397.155::DOUBLE AS a, 0.006674372230614::DOUBLE AS e2, "
         f"radians({deg.format(46, 57, 8.66)}) AS p0, radians({deg.format(7, 26, 22.5)}) AS l0"),
        "*, sqrt(e2) AS x, a * sqrt(1 - e2) / (1 - e2 * pow(sin(p0), 2)) AS r, sqrt(1 + e2 / (1 - e2) * pow(cos(p0), 4)) AS al",
        "*, asin(sin(p0) / al) AS b0",
        ("*, ln(tan(pi() / 4 + b0 / 2)) - al * ln(tan(pi() / 4 + p0 / 2)) + al * x / 2 * ln((1 + x * sin(p0)) / (1 - x * sin(p0))) AS k, "
         "(e - 2600000) / r AS l, 2 * (atan(exp((n - 1200000) / r)) - pi() / 4) AS b"),
        ("*, asin(cos(b0) * sin(b) + sin(b0) * cos(b) * cos(l)) AS p, "
         "l0 + atan(sin(l) / (cos(b0) * cos(l) - sin(b0) * tan(b))) / al AS lam"),
        "*, (ln(tan(pi() / 4 + p / 2)) - k) / al AS q",
        *["* REPLACE (2 * atan(exp(q + x * ln(tan(pi() / 4 + asin(x * sin(p)) / 2)))) - pi() / 2 AS p)"] * 8,
        "*, a / sqrt(1 - e2 * pow(sin(p), 2)) AS nu, 6378137::DOUBLE AS wa, 1 / 298.257223563 AS f",
        ("*, nu * cos(p) * cos(lam) + 674.374 AS gx, nu * cos(p) * sin(lam) + 15.056 AS gy, nu * (1 - e2) * sin(p) + 405.346 AS gz, "
         "f * (2 - f) AS w2"),
        "*, sqrt(gx * gx + gy * gy) AS gp, atan2(gz, sqrt(gx * gx + gy * gy) * (1 - w2)) AS phi",
        *["* REPLACE (atan2(gz + w2 * wa / sqrt(1 - w2 * pow(sin(phi), 2)) * sin(phi), gp) AS phi)"] * 12,
        "*, degrees(phi) AS lat, degrees(atan2(gy, gx)) AS lon",
    ]
    for step in steps:
        source = f"(SELECT {step} FROM {source})"
    return source


_REG = _wgs84("(SELECT n_name AS name, n_nationkey, CAST(2600000 + n_nationkey * 10000 + n_regionkey * 100 AS DOUBLE) AS e, "
              "CAST(1200000 + n_regionkey * 20000 + n_nationkey * 500 AS DOUBLE) AS n FROM nation WHERE n_regionkey < 4)")
REGISTER = f"""
reg AS (SELECT name, n_nationkey, lat AS r_lat, lon AS r_lon FROM {_REG})"""

AUDIT = """
j AS (SELECT l_orderkey, l_linenumber, CAST(year(o_orderdate) AS INTEGER) AS yr,
             CASE WHEN l_orderkey % 7 = 0 THEN c_custkey + 1 ELSE c_custkey END AS f_custkey, c_custkey,
             CASE WHEN l_orderkey % 11 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS f_nationkey, c_nationkey,
             CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN 'X'
                  ELSE o_orderstatus END AS f_orderstatus, o_orderstatus,
             CASE WHEN l_linenumber = 7 THEN lower(c_mktsegment) ELSE c_mktsegment END AS f_mktsegment,
             c_mktsegment
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""
AUDIT_COLS = [("custkey", "f_custkey", "c_custkey"), ("nationkey", "f_nationkey", "c_nationkey"),
              ("orderstatus", "f_orderstatus", "o_orderstatus"), ("mktsegment", "f_mktsegment", "c_mktsegment")]

MISMATCH_COUNTS = "mc AS (" + " UNION ALL ".join(
    f"SELECT yr, '{n}' AS column_name, count_if({c} IS DISTINCT FROM {p}) AS mismatches FROM j GROUP BY yr"
    for n, c, p in AUDIT_COLS) + ")"

GRID = """
sl AS (SELECT DISTINCT CAST(floor(epoch(ts) / 300) AS BIGINT) AS slot FROM events),
bd AS (SELECT min(slot) AS lo, max(slot) AS hi FROM sl),
g AS (SELECT unnest(range(lo, hi + 1)) AS slot FROM bd),
m AS (SELECT slot, make_timestamp(slot * 300 * 1000000) AS slot_start
      FROM g WHERE slot NOT IN (SELECT slot FROM sl))"""

LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LI_DOUBLE = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
O_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _ndistinct(col: str, is_double: bool = False) -> str:
    v = f"({col} + 0.0)" if is_double else col
    return f"(COUNT(DISTINCT {v}) + CASE WHEN COUNT(*) > COUNT({col}) THEN 1 ELSE 0 END)"


def _rules(rules, source: str, with_counts: bool) -> str:
    aggs = ", ".join(f"count_if(NOT coalesce({pred}, false)) AS r{i}" for i, (_, _, pred) in enumerate(rules))
    rows = []
    for i, (fam, name, _) in enumerate(rules):
        cols = f"'{fam}' AS family, '{name}' AS rule"
        cols += f", r{i} AS violations, r{i} = 0 AS all_pass" if with_counts else f", r{i} = 0 AS all_pass"
        rows.append(f"SELECT {cols} FROM w")
    return f"WITH {source}, w AS (SELECT {aggs} FROM src) " + " UNION ALL ".join(rows)


PATCHED = """
    SELECT c_custkey, CASE c_custkey WHEN 1 THEN 0.0 WHEN 2 THEN 100.5 WHEN 3 THEN -1.0 ELSE c_acctbal END AS c_acctbal,
           CASE c_custkey WHEN 2 THEN 'PATCHED' WHEN 5 THEN NULL ELSE c_mktsegment END AS c_mktsegment
    FROM customer"""

# Rules as (family, rule, what a valid row satisfies).
LINEITEM_RULES = [
    ("Ungrouped", "linenumber between 1 and 7", "l_linenumber >= 1 AND l_linenumber <= 7"),
    ("Ungrouped", "returnflag is R, A or N", "l_returnflag = 'R' OR l_returnflag = 'A' OR l_returnflag = 'N'"),
    ("Ungrouped", "ships on or after the order date", "NOT l_shipdate < o_orderdate"),
    ("Between", "quantity between 1 and 50", "l_quantity >= 1 AND l_quantity <= 50"),
    ("Between", "discount between 0 and 0.1", "l_discount >= 0 AND l_discount <= CAST(0.1 AS DOUBLE)"),
    ("Less or equal", "tax at most 0.08", "NOT l_tax > CAST(0.08 AS DOUBLE)"),
    ("Less or equal", "discount at most tax", "NOT l_discount > l_tax"),
]
EVENT_RULES = [
    ("Between 0 and 86399", "second of day in range", "sec_of_day >= 0 AND sec_of_day < 86400"),
    ("Ungrouped", "value not negative", "NOT value < 0"),
    ("Ungrouped", "known event type", "list_contains(['signup', 'view', 'click', 'purchase', 'error'], event_type)"),
    ("Less or equal", "value at most 250", "NOT value > 250"),
]

_GRID = _wgs84("(SELECT c_custkey, CAST(2480000 + (c_custkey * 37) % 350000 AS DOUBLE) AS e, "
               "CAST(1070000 + (c_custkey * 53) % 220000 AS DOUBLE) AS n FROM customer)")

ORACLE_SQL: dict[str, str] = {
    "daily_counts": "SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders GROUP BY 1",

    "month_day_rollup": """
        SELECT yr, mon, dom, COUNT(*) AS n, CAST(GROUPING(yr, mon, dom) AS INTEGER) AS level
        FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mon,
                     CAST(day(o_orderdate) AS INTEGER) AS dom FROM orders)
        GROUP BY ROLLUP (yr, mon, dom)""",

    "weekday_counts": """
        SELECT CAST(isodow(d) - 1 AS INTEGER) AS weekday_num, dayname(d) AS weekday, COUNT(*) AS n
        FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY 1, 2""",

    "weekday_weekend_series": """
        SELECT d AS day, CAST(year(d) AS INTEGER) AS yr, CAST(month(d) AS INTEGER) AS mon,
               CAST(dayofmonth(d) AS INTEGER) AS dom, CAST(dayofyear(d) AS INTEGER) AS doy,
               isodow(d) >= 6 AS is_weekend, n
        FROM (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1)""",

    "day_counts_in_month": """
        SELECT CAST(dayofmonth(o_orderdate) AS INTEGER) AS dom, COUNT(*) AS n FROM orders
        WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01' GROUP BY 1""",

    "top_k_keys": "SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 10",

    "top_k_named": """
        SELECT p_name, CAST(COUNT(*) AS BIGINT) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY p_name ORDER BY n DESC, p_name LIMIT 10""",

    "top_k_groups_all_rows": """
        WITH o AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, o_totalprice
                   FROM orders WHERE year(o_orderdate) IN (1996, 1998)),
             g AS (SELECT o_custkey, max(o_totalprice) AS group_max FROM o GROUP BY 1
                   ORDER BY group_max DESC NULLS LAST, o_custkey LIMIT 5)
        SELECT o.o_orderkey, o.o_custkey, o.yr, o.o_totalprice, g.group_max FROM o JOIN g USING (o_custkey)""",

    "category_bucket": """
        SELECT p_size,
               CASE WHEN p_size BETWEEN 2 AND 17 THEN 'Tram' WHEN p_size BETWEEN 18 AND 28 THEN 'Bergbahn'
                    WHEN p_size BETWEEN 29 AND 916 THEN 'Bus' ELSE 'Other' END AS category,
               COUNT(*) AS n_parts
        FROM part GROUP BY p_size""",

    "distinct_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({_ndistinct(c, c in LI_DOUBLE)} AS BIGINT) AS n_distinct FROM lineitem"
        for c in LI_COLS),

    "unique_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({_ndistinct(c, c == 'o_totalprice')} AS BIGINT) AS n_distinct, "
        f"{_ndistinct(c, c == 'o_totalprice')} = COUNT(*) AS is_unique FROM orders" for c in O_COLS),

    "empty_profile": "WITH " + DIRTY_CUSTOMER + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count_if({_empty(c, t)}) AS empty_cells, "
        f"round(count_if({_empty(c, t)}) * {D} / COUNT(*), 4) AS percentage FROM c" for c, t in CUST_COLS),

    "empty_profile_split": "WITH " + DIRTY_CUSTOMER + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count_if({_empty(c, t)} AND c_acctbal > 0) AS empty_when_true, "
        f"count_if({_empty(c, t)} AND NOT coalesce(c_acctbal > 0, false)) AS empty_when_false FROM c"
        for c, t in CUST_COLS),

    "empty_total": "WITH " + DIRTY_CUSTOMER + " SELECT CAST(" + " + ".join(
        f"count_if({_empty(c, t)})" for c, t in CUST_COLS) + " AS BIGINT) AS empty_cells FROM c",

    "value_counts_two_sources": """
        WITH a AS (SELECT c_nationkey AS k, COUNT(*) AS n FROM customer GROUP BY 1),
             b AS (SELECT s_nationkey AS k, COUNT(*) AS n FROM supplier GROUP BY 1),
             w AS (SELECT COALESCE(a.k, b.k) AS n_nationkey, COALESCE(a.n, 0) AS customers,
                          COALESCE(b.n, 0) AS suppliers FROM a FULL OUTER JOIN b ON a.k = b.k)
        SELECT n_nationkey, greatest(customers, suppliers) AS max_count, 'customers' AS source, customers AS n FROM w
        UNION ALL
        SELECT n_nationkey, greatest(customers, suppliers), 'suppliers', suppliers FROM w""",

    "split_explode_counts": """
        SELECT word, COUNT(*) AS n FROM (SELECT trim(unnest(string_split(p_name, ' '))) AS word FROM part)
        WHERE word IS NOT NULL GROUP BY 1""",

    "first_token_counts": """
        SELECT split_part(p_name, ' ', 1) AS token, COUNT(*) AS n_parts FROM part
        WHERE p_partkey IN (SELECT l_partkey FROM lineitem) GROUP BY 1""",

    "lookup_label_counts": """
        SELECT r_name, n_name, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",

    "active_share": f"""
        SELECT count_if(o_orderstatus = 'F') AS n_active, count_if(NOT (o_orderstatus = 'F')) AS n_inactive,
               round(count_if(o_orderstatus = 'F') * {D} / COUNT(*), 4) AS active_pct FROM orders""",

    "rule_violations": _rules(LINEITEM_RULES, "src AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
                              True),

    "rule_flags": _rules(EVENT_RULES, "src AS (SELECT *, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS sec_of_day "
                                      "FROM events)", False),

    "dedup_exact": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",

    "dedup_counts": """
        SELECT CAST(COUNT(*) AS BIGINT) AS rows_before,
               (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS rows_after,
               CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
                    AS BIGINT) AS duplicates_removed
        FROM lineitem""",

    "duplicate_subset": """
        SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                              COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS group_size FROM lineitem)
        WHERE group_size > 1""",

    "repeats_after_first": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                   ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                            l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem)
        WHERE rn > 1""",

    "same_location": """
        WITH c AS (SELECT c_nationkey, c_mktsegment, floor(c_acctbal / 100) AS bal_band, c_custkey % 3 AS c_mod3
                   FROM customer
                   WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL AND c_acctbal IS NOT NULL),
             a AS (SELECT COUNT(*) AS m FROM c GROUP BY c_nationkey, c_mktsegment, bal_band),
             b AS (SELECT COUNT(*) AS m FROM c GROUP BY c_nationkey, c_mktsegment, bal_band, c_mod3)
        SELECT CAST(coalesce((SELECT SUM(m) FROM a WHERE m > 1), 0) AS BIGINT) AS same_location,
               CAST(coalesce((SELECT SUM(m) FROM b WHERE m > 1), 0) AS BIGINT) AS also_same""",

    "dedup_text": """
        SELECT doc_id, lang, n_chars FROM (
          SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
        WHERE rn = 1""",

    "sentinel_to_null": """
        SELECT p_partkey, CASE WHEN b IN ('', 'None', 'Null') THEN NULL ELSE b END AS p_brand
        FROM (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'None' WHEN p_partkey % 10 = 0 THEN ''
                                     WHEN p_partkey % 11 = 0 THEN 'Null' ELSE p_brand END AS b FROM part)""",

    "literal_replace": "SELECT c_custkey, replace(c_name, 'Customer#', 'C.') AS c_name FROM customer",

    "narrow_integers": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, bool_and(coalesce({c} = floor({c}), false)) AS all_whole FROM lineitem"
        for c in ["l_quantity", "l_extendedprice", "l_tax"]),

    "split_pair": """
        SELECT c_custkey, split_part(s, ', ', 1) AS first, split_part(s, ', ', 2) AS second
        FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) || ', ' || CAST(c_nationkey AS VARCHAR) AS s
              FROM customer)""",

    "parse_dates_coerce": "WITH " + PARSED + " SELECT o_orderkey, date_text, parsed FROM pd",

    "parse_dates_lost": "WITH " + PARSED + """
        SELECT COUNT(date_text) AS text_dates, COUNT(parsed) AS valid_dates,
               COUNT(date_text) - COUNT(parsed) AS false_dates FROM pd""",

    "suffix_filter": "WITH " + DATE_TEXT + " SELECT o_orderkey, date_text FROM t WHERE NOT (date_text LIKE '%.97')",

    "regex_date_check": "WITH " + DATE_TEXT + """
        SELECT o_orderkey, date_text FROM t
        WHERE date_text IS NOT NULL AND NOT coalesce(regexp_matches(date_text, '^[0-9]{2}\\.[0-9]{2}\\.[0-9]{2}'), false)""",

    "date_consistency": """
        WITH jn AS (SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS od
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
             d AS (SELECT od AS b, od + CAST(l_linenumber % 2 AS INTEGER) AS v,
                          CASE WHEN l_orderkey % 23 = 0 THEN NULL
                               ELSE od + CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END END AS n FROM jn)
        SELECT count_if(b IS NOT NULL AND v IS NOT NULL AND n IS NOT NULL AND (b <> v OR b <> n OR v <> n))
                 AS different_dates,
               count_if(b IS NULL OR v IS NULL OR n IS NULL) AS false_dates FROM d""",

    "partial_fill_rows": """
        WITH t AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS a,
                          CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS b,
                          CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS c,
                          CASE WHEN c_custkey % 13 = 0 THEN '' ELSE CAST(c_acctbal AS VARCHAR) END AS e
                   FROM customer),
             k AS (SELECT (CASE WHEN a IS NULL OR a = '' THEN 1 ELSE 0 END) + (CASE WHEN b IS NULL OR b = '' THEN 1 ELSE 0 END)
                        + (CASE WHEN c IS NULL OR c = '' THEN 1 ELSE 0 END) + (CASE WHEN e IS NULL OR e = '' THEN 1 ELSE 0 END)
                          AS k FROM t)
        SELECT count_if(k > 0 AND k < 4) AS inconsistent_rows FROM k""",

    "fk_orphans": "WITH " + ORPHANS + " SELECT * FROM orph",

    "fk_check": "WITH " + ORPHANS + " SELECT period, side, COUNT(*) AS orphans FROM orph GROUP BY 1, 2",

    "orphan_reappears": "WITH " + ORPHANS + """,
        yr AS (SELECT CAST(unnest(generate_series(1992, 1997)) AS INTEGER) AS y),
        reg AS (SELECT 'supplier' AS side, s_suppkey AS fk_value, y FROM supplier, yr
                WHERE s_acctbal > 0 OR y >= 1994 + s_suppkey % 4
                UNION ALL
                SELECT 'part', p_partkey, y FROM part, yr WHERE p_size > 3 OR y >= 1994 + p_partkey % 4),
        pr AS (SELECT DISTINCT side, fk_value, period FROM orph)
        SELECT period, COUNT(*) AS orphan_keys,
               count_if(EXISTS (SELECT 1 FROM reg WHERE reg.side = pr.side AND reg.fk_value = pr.fk_value
                                AND reg.y > pr.period)) AS reappear_later
        FROM pr GROUP BY period""",

    "wrong_period_rows": """
        WITH f AS (SELECT o_orderdate,
                          CASE WHEN o_orderkey % 10 = 0
                               THEN CAST(year(CAST(o_orderdate AS DATE) - INTERVAL 30 DAY) AS INTEGER)
                               ELSE CAST(year(o_orderdate) AS INTEGER) END AS file_year FROM orders)
        SELECT file_year, CAST(year(o_orderdate) AS INTEGER) AS true_year, COUNT(*) AS n FROM f
        WHERE file_year <> year(o_orderdate) GROUP BY 1, 2""",

    "repartitioned": "SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) AS n FROM orders GROUP BY 1",

    "snapshot_consistency": "WITH " + SNAP + " SELECT * FROM chg",

    "ids_next_year": "WITH " + SNAP + " SELECT jahr, COUNT(*) AS missing FROM miss GROUP BY jahr",

    "reactivated": "WITH " + SNAP + """
        SELECT x.jahr, COUNT(*) AS reactivated FROM s x JOIN s y ON x.id = y.id AND y.jahr = x.jahr + 1
        WHERE NOT x.aktiv AND y.aktiv GROUP BY x.jahr""",

    "snapshot_merge": "WITH " + SNAP + """
        SELECT id, jahr, label, grp, aktiv FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY jahr DESC) AS rn FROM s) WHERE rn = 1""",

    "merge_gate": "WITH " + SNAP + """,
        kc AS (SELECT CAST(coalesce(SUM(inconsistent), 0) AS BIGINT) AS k FROM chg WHERE column_name IN ('grp')),
        mi AS (SELECT COUNT(*) AS k FROM miss)
        SELECT kc.k = 0 AS consistent, mi.k = 0 AS contained, kc.k = 0 AND mi.k = 0 AS mergeable FROM kc, mi""",

    "sentinel_fill": "WITH " + LOCATED + """
        SELECT c_custkey, latitude, longitude,
               CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL AND bearing IS NULL
                    THEN CAST(-1.0 AS DOUBLE) ELSE bearing END AS bearing FROM lc""",

    "fill_by_name": "WITH " + REGISTER + """
        SELECT c_custkey, round(r_lat, 6) AS latitude, round(r_lon, 6) AS longitude
        FROM customer JOIN nation n ON c_nationkey = n.n_nationkey LEFT JOIN reg ON n.n_name = reg.name""",

    "fill_by_fk": "WITH " + LOCATED + "," + REGISTER + """,
        par AS (SELECT n_nationkey, CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE r_lat END AS p_lat,
                       r_lon AS p_lon FROM reg),
        h AS (SELECT lc.*, par.p_lat, par.p_lon, lc.latitude IS NULL AND par.n_nationkey IS NOT NULL AS hit
              FROM lc LEFT JOIN par ON lc.c_nationkey = par.n_nationkey)
        SELECT c_custkey, round(CASE WHEN hit THEN p_lat ELSE latitude END, 6) AS latitude,
               round(CASE WHEN hit THEN p_lon ELSE longitude END, 6) AS longitude,
               CASE WHEN hit THEN CAST(-2.0 AS DOUBLE) ELSE bearing END AS bearing FROM h""",

    "keyed_patch": PATCHED,

    "denorm_audit": "WITH " + AUDIT + """
        SELECT l_orderkey, l_linenumber, yr, f_custkey, c_custkey, f_nationkey, c_nationkey,
               f_orderstatus, o_orderstatus, f_mktsegment, c_mktsegment FROM j
        WHERE f_custkey <> c_custkey OR f_nationkey <> c_nationkey OR f_orderstatus <> o_orderstatus
           OR f_mktsegment <> c_mktsegment""",

    "mismatch_counts": "WITH " + AUDIT + ", " + MISMATCH_COUNTS + " SELECT * FROM mc",

    "mismatch_pairs": "WITH " + AUDIT + ", mm AS (" + " UNION ALL ".join(
        f"SELECT yr, '{n}' AS column_name, CAST({c} AS VARCHAR) AS child_value, CAST({p} AS VARCHAR) AS parent_value "
        f"FROM j WHERE {c} <> {p}" for n, c, p in AUDIT_COLS) +
        ") SELECT yr, column_name, child_value, parent_value, COUNT(*) AS n FROM mm GROUP BY ALL",

    "mismatch_share": f"""
        WITH o AS (SELECT * FROM orders WHERE o_orderkey % 29 <> 0),
             k AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, l_orderkey, l_linenumber FROM lineitem),
             tot AS (SELECT yr, COUNT(*) AS total_rows FROM k GROUP BY yr),
             j AS (SELECT yr, l_orderkey % 7 = 0 AS custkey, l_orderkey % 11 = 0 AS nationkey,
                          (CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END)
                            IS DISTINCT FROM o_orderstatus AS orderstatus,
                          (CASE WHEN l_linenumber = 7 THEN lower(c_mktsegment) ELSE c_mktsegment END)
                            IS DISTINCT FROM c_mktsegment AS mktsegment
                   FROM k JOIN o ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
             mc AS ({" UNION ALL ".join(f"SELECT tot.yr, '{c}' AS column_name, (SELECT count_if({c}) FROM j WHERE j.yr = tot.yr) AS mismatches, total_rows FROM tot" for c in ("custkey", "nationkey", "orderstatus", "mktsegment"))})
        SELECT yr, column_name, mismatches, total_rows, round(mismatches * {D} / total_rows, 4) AS percent FROM mc""",

    "composite_lookup": "WITH " + AUDIT + """,
        t AS (SELECT DISTINCT l_orderkey, f_custkey FROM j)
        SELECT COUNT(*) AS n_pairs,
               count_if(o.o_orderkey IS NULL OR t.f_custkey IS DISTINCT FROM o.o_custkey) AS n_inconsistent
        FROM t LEFT JOIN orders o ON t.l_orderkey = o.o_orderkey""",

    "missing_timestamps_summary": "WITH " + GRID + f"""
        SELECT CAST((SELECT hi - lo + 1 FROM bd) AS BIGINT) AS grid_slots, COUNT(*) AS missing,
               round(COUNT(*) * {D} / (SELECT hi - lo + 1 FROM bd), 0) AS missing_pct FROM m""",

    "missing_timestamps_hour": "WITH " + GRID +
        " SELECT CAST(hour(slot_start) AS INTEGER) AS hour, COUNT(*) AS missing FROM m GROUP BY 1",

    "missing_timestamps_weekday": "WITH " + GRID +
        " SELECT CAST(isodow(slot_start) - 1 AS INTEGER) AS weekday, COUNT(*) AS missing FROM m GROUP BY 1",

    "missing_timestamps_month": "WITH " + GRID +
        " SELECT CAST(month(slot_start) AS INTEGER) AS month, COUNT(*) AS missing FROM m GROUP BY 1",

    "grid_fill": """
        WITH c AS (SELECT event_type, CAST(floor(epoch(ts) / 300) AS BIGINT) AS slot, sum(value) AS v
                   FROM events GROUP BY 1, 2),
             st AS (SELECT COUNT(*) AS observed, count_if(coalesce(v, 0) = 0) AS zero_before,
                           COUNT(DISTINCT event_type) AS entities, min(slot) AS lo, max(slot) AS hi FROM c)
        SELECT CAST(entities * (hi - lo + 1) AS BIGINT) AS grid_cells, observed, zero_before,
               CAST(zero_before + entities * (hi - lo + 1) - observed AS BIGINT) AS zero_after FROM st""",

    "search": """
        SELECT p_partkey, p_name, p_type FROM part
        WHERE regexp_matches(coalesce(p_name, ''), 'blue|red') AND regexp_matches(coalesce(p_type, ''), '^S')""",

    "search_not": "SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(coalesce(p_name, ''), 'ring')",

    "page": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 20",

    "describe": """
        SELECT COUNT(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean,
               round(stddev_samp(o_totalprice), 4) AS std, CAST(min(o_totalprice) AS DOUBLE) AS min,
               round(quantile_cont(o_totalprice, 0.25), 4) AS p25, round(quantile_cont(o_totalprice, 0.5), 4) AS p50,
               round(quantile_cont(o_totalprice, 0.75), 4) AS p75, CAST(max(o_totalprice) AS DOUBLE) AS max
        FROM orders""",

    "hash_sample": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE ((o_orderkey % 1000003) * 2654435761) % 1000003 % 100 < 10""",

    "row_ids": """
        SELECT s_suppkey, s_name,
               CAST(row_number() OVER (ORDER BY s_suppkey) + (SELECT max(n_nationkey) FROM nation) AS BIGINT) AS row_id
        FROM supplier""",

    "table_profile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST((SELECT COUNT(*) FROM information_schema.columns "
        f"WHERE table_name = '{t}') AS INTEGER) AS n_columns, COUNT(*) AS n_rows FROM {t}" for t in TABLE_NAMES),

    "group_max_rows": """
        SELECT o_orderkey, o_custkey, o_totalprice, max(o_totalprice) OVER (PARTITION BY o_custkey) AS group_max
        FROM orders""",

    "ledger_rollup": """
        WITH li AS (SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS yr FROM lineitem),
             g AS (SELECT yr, COUNT(*) AS m FROM li GROUP BY yr, l_orderkey, l_linenumber),
             dups AS (SELECT yr, SUM(m) - COUNT(*) AS dups FROM g GROUP BY yr),
             dd AS (SELECT count_if(CAST(l_shipdate AS DATE) <> CAST(o_orderdate AS DATE)) AS diff,
                           count_if(l_shipdate IS NULL OR o_orderdate IS NULL) AS fals
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT 'Lineitem' AS table_name, 'Lineitem_Deleting_Duplicate_Rows' AS process, CAST(0.0 AS DOUBLE) AS time,
               'Duplicate Rows: ' || CAST(CAST(SUM(dups) AS BIGINT) AS VARCHAR) AS output FROM dups
        UNION ALL
        SELECT 'Lineitem', 'Lineitem_Checking_Dates', CAST(0.0 AS DOUBLE),
               'Different Dates in Rows: ' || CAST(diff AS VARCHAR) || '; False Dates: ' || CAST(fals AS VARCHAR)
        FROM dd""",

    "report_parse": "WITH " + AUDIT + ", " + MISMATCH_COUNTS +
        " SELECT yr AS year, column_name, mismatches AS count FROM mc",

    "file_name_dates": """
        SELECT DISTINCT 'Fahrzeiten_SOLL_IST_' || strftime(ws, '%Y%m%d') || '_' || strftime(ws + 6, '%Y%m%d') || '.csv'
                 AS file_name, ws AS week_start, ws + 6 AS week_end
        FROM (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS ws FROM orders)""",

    "key_set_ops": """
        WITH a AS (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996),
             b AS (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997)
        SELECT 'union' AS op, (SELECT COUNT(*) FROM (SELECT o_custkey FROM a UNION SELECT o_custkey FROM b)) AS n
        UNION ALL
        SELECT 'intersect', (SELECT COUNT(*) FROM (SELECT o_custkey FROM a INTERSECT SELECT o_custkey FROM b))
        UNION ALL
        SELECT 'difference', (SELECT COUNT(*) FROM (SELECT o_custkey FROM a EXCEPT SELECT o_custkey FROM b))""",

    "monthly_counts_named": """
        SELECT yr, mon,
               ['Januar', 'Februar', 'März', 'April', 'Mai', 'Juni', 'Juli', 'August', 'September', 'Oktober',
                'November', 'Dezember'][mon] AS monat,
               CAST(dayofmonth(last_day(d)) AS INTEGER) AS days, n,
               format('{:,}', n) AS n_text, replace(format('{:,}', n * 1000), ',', '.') AS n_thousands_dot
        FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mon,
                     COUNT(*) AS n, min(CAST(o_orderdate AS DATE)) AS d
              FROM orders GROUP BY 1, 2)""",

    "grid_to_wgs84": f"SELECT c_custkey, round(lat, 6) AS latitude, round(lon, 6) AS longitude FROM {_GRID}",
    **RUNS_SQL,
}


def _bigint_count_if(sql: str) -> str:
    """Wrap every count_if(...) in CAST(... AS BIGINT): DuckDB returns
    HUGEINT where Spark returns bigint."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        out.append("CAST(" + key + _bigint_count_if(sql[j + len(key):k - 1]) + ") AS BIGINT)")
        i = k


ORACLE_SQL = {k: _bigint_count_if(v) for k, v in ORACLE_SQL.items()}
