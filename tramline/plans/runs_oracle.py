"""DuckDB SQL of the queries in ``tramline.plans.runs``, written on its own:
nothing of the library is imported."""

from __future__ import annotations

ORDER_TEXT = """
t AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
             CASE WHEN o_orderkey % 31 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
             CASE WHEN o_orderkey % 37 = 0 THEN '1997-13-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate
      FROM orders),
r AS (SELECT o_orderkey, 'o_custkey' AS column_name, o_custkey AS value FROM t WHERE try_cast(o_custkey AS TINYINT) IS NULL
      UNION ALL SELECT o_orderkey, 'o_totalprice', o_totalprice FROM t WHERE try_cast(o_totalprice AS DOUBLE) IS NULL
      UNION ALL SELECT o_orderkey, 'o_orderdate', o_orderdate FROM t WHERE try_cast(o_orderdate AS DATE) IS NULL)"""

SNAP = """
s AS (SELECT id, jahr,
             CASE WHEN id % 13 = jahr % 13 THEN 'L' || CAST(jahr AS VARCHAR) ELSE 'L' || CAST(id % 4 AS VARCHAR) END AS label,
             CASE WHEN id % 17 = jahr % 17 THEN NULL ELSE id % 5 END AS grp, (id + jahr) % 5 <> 0 AS aktiv
      FROM (SELECT DISTINCT o_custkey AS id, CAST(year(o_orderdate) AS INTEGER) AS jahr FROM orders))"""

AUDIT = """
j AS (SELECT l_orderkey, l_linenumber, CAST(year(o_orderdate) AS INTEGER) AS yr,
             c_custkey + (l_orderkey % 7 = 0)::INTEGER AS f_custkey, c_custkey,
             c_nationkey + (l_orderkey % 11 = 0)::INTEGER AS f_nationkey, c_nationkey,
             CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS f_orderstatus,
             o_orderstatus, CASE WHEN l_linenumber = 7 THEN lower(c_mktsegment) ELSE c_mktsegment END AS f_mktsegment, c_mktsegment
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""
AUDIT_COLS = ["l_orderkey", "l_linenumber", "yr", "f_custkey", "c_custkey", "f_nationkey", "c_nationkey", "f_orderstatus",
              "o_orderstatus", "f_mktsegment", "c_mktsegment"]

# Codes and names of the cantons.
CANTON_NAMES = [
    ("AG", "Aargau"), ("AI", "Appenzell Innerrhoden"), ("AR", "Appenzell Ausserrhoden"), ("BE", "Bern"),
    ("BL", "Basel-Landschaft"), ("BS", "Basel-Stadt"), ("FR", "Fribourg"), ("GE", "Genève"), ("GL", "Glarus"),
    ("GR", "Graubünden"), ("JU", "Jura"), ("LU", "Luzern"), ("NE", "Neuchâtel"), ("NW", "Nidwalden"), ("OW", "Obwalden"),
    ("SG", "St. Gallen"), ("SH", "Schaffhausen"), ("SO", "Solothurn"), ("SZ", "Schwyz"), ("TG", "Thurgau"),
    ("TI", "Ticino"), ("UR", "Uri"), ("VD", "Vaud"), ("VS", "Valais"), ("ZG", "Zug"), ("ZH", "Zürich")]
_CODES = ", ".join(f"'{c}'" for c, _ in CANTON_NAMES)
_NAMES = ", ".join(f"('{c}', '{n}')" for c, n in CANTON_NAMES)

STATIONS = f"""
st AS (SELECT 'S' || CAST(c_custkey % 40 AS VARCHAR) AS bahnhof_lang,
              CAST(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 2018 + 2 * (c_custkey % 3) END AS INTEGER) AS jahr,
              c_acctbal AS verkehr,
              CASE WHEN c_custkey % 11 = 0 THEN 'XX' WHEN c_custkey % 13 = 0 THEN NULL ELSE [{_CODES}][c_nationkey + 1] END AS kanton,
              CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS owner,
              c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN '; EXTRA;' ELSE '' END AS companies
       FROM customer)"""

DESCRIBED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe(column: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    q = ", ".join(f"round(quantile_cont({x}, {p / 100}), 4) AS p{p}" for p in (25, 50, 75))
    return (f"SELECT '{column}' AS column_name, count({column}) AS count, round(avg({x}), 4) AS mean, "
            f"round(stddev_samp({x}), 4) AS std, min({x}) AS min, {q}, max({x}) AS max FROM lineitem")


def _profile(column: str) -> str:
    return (f"SELECT '{column}' AS column_name, CAST(n AS BIGINT) AS n_distinct, n = m AS is_unique FROM (SELECT count(DISTINCT {column}) "
            f"+ (count(*) > count({column}))::INTEGER AS n, count(*) AS m FROM j)")


def _gate(name: str, region: int, changed: str) -> str:
    return f"""SELECT '{name}' AS table_name, ({changed}) AS consistent,
       NOT EXISTS (SELECT 1 FROM w x WHERE x.jahr < (SELECT max(jahr) FROM w) AND NOT EXISTS
           (SELECT 1 FROM w y WHERE y.id = x.id AND y.jahr = x.jahr + 1)) AS contained,
       (SELECT n_regionkey_even FROM (SELECT r_regionkey % 2 <> 0 AS n_regionkey_even FROM region WHERE r_name = '{name}')) AS unmerged"""


_CHANGED = "NOT EXISTS (SELECT 1 FROM w x JOIN w y ON x.id = y.id AND y.jahr = x.jahr + 1 WHERE {})"

ORACLE_SQL = {
    "rejected_cell_counts": f"WITH {ORDER_TEXT} SELECT column_name, count(*) AS rejected FROM r GROUP BY 1",
    "csv_rescued": f"WITH {ORDER_TEXT} SELECT * FROM r",
    "csv_typed": f"""WITH {ORDER_TEXT} SELECT o_orderkey, try_cast(o_custkey AS TINYINT) AS o_custkey,
                     try_cast(o_totalprice AS DOUBLE) AS o_totalprice FROM t""",
    "decimal_comma": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 29 <> 0 THEN o_totalprice END AS price,
               CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey / 2
                    ELSE 2 * round((o_orderkey - 1) / 4 + 0.25) END AS half FROM orders""",
    "dedup_rows": "SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_quantity, l_returnflag, l_shipdate FROM lineitem",
    "describe_table": " UNION ALL ".join(_describe(c) for c in DESCRIBED),
    "unique_profile_joined": f"WITH {AUDIT} " + " UNION ALL ".join(_profile(c) for c in AUDIT_COLS),
    "narrowed_columns": "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, l_tax FROM lineitem",
    "shaped_columns": """
        SELECT CAST(2022 AS INTEGER) AS jahr, c_custkey, replace(c_name, 'Customer#0000', 'C') AS name, c_mktsegment FROM customer""",
    "dropped_if_clean": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
               CAST(o_orderdate AS DATE) + (o_orderkey % 97 = 0)::INTEGER AS other_day FROM orders""",
    "sql_over_frames": "SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    "composite_pairs": f"""WITH {AUDIT} SELECT t.*, o.o_orderkey IS NOT NULL AND t.o_custkey IS NOT DISTINCT FROM o.o_custkey
               AND t.o_orderstatus IS NOT DISTINCT FROM o.o_orderstatus AS consistent
        FROM (SELECT DISTINCT l_orderkey, f_custkey AS o_custkey, f_orderstatus AS o_orderstatus FROM j) t
        LEFT JOIN orders o ON t.l_orderkey = o.o_orderkey""",
    "refiled_rows": """
        WITH f AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS new_year, CAST(CASE WHEN o_orderkey % 10 = 0
                   THEN year(CAST(o_orderdate AS DATE) - 30) ELSE year(o_orderdate) END AS INTEGER) AS was_filed FROM orders)
        SELECT o_orderkey, was_filed, new_year FROM f WHERE was_filed <> new_year""",
    "page_deep": """
        SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
        QUALIFY row_number() OVER (ORDER BY o_totalprice NULLS FIRST, o_orderkey) - 1
                BETWEEN 25 * ((SELECT count(*) FROM orders) // 50 - 1) AND 25 * ((SELECT count(*) FROM orders) // 50) - 1""",
    "snapshot_last_year": f"WITH {SNAP} SELECT id, label, grp, aktiv FROM s WHERE jahr = (SELECT max(jahr) FROM s)",
    "snapshot_union": f"WITH {SNAP} SELECT jahr, id, label, CASE WHEN jahr > 1994 THEN aktiv END AS aktiv FROM s WHERE jahr BETWEEN 1992 AND 1998",
    "merge_decision": f"WITH {SNAP}, w AS (SELECT * FROM s WHERE jahr >= 1997), g AS ("
        + _gate("AFRICA", 0, _CHANGED.format("x.grp IS DISTINCT FROM y.grp")) + " UNION ALL "
        + _gate("AMERICA", 1, _CHANGED.format("x.grp IS DISTINCT FROM y.grp OR x.label IS DISTINCT FROM y.label"))
        + ") SELECT *, consistent AND contained AND unmerged AS mergeable FROM g",
    "patched_from_table": """
        SELECT c_custkey, CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal ELSE c_acctbal END AS c_acctbal,
               CASE WHEN s_suppkey % 3 = 1 THEN NULL ELSE c_mktsegment END AS c_mktsegment
        FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
    "versioned_rows": "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders WHERE o_orderkey % 3 <> 0",
    "single_file_rows": "SELECT p_partkey, p_name, CAST(p_size AS INTEGER) AS p_size FROM part",
    "step_ledger": """
        WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem UNION ALL
                   SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey % 5 = 0),
             b AS (SELECT DISTINCT * FROM a)
        SELECT 'Lineitem_Deleting_Duplicate_Rows' AS process,
               'Duplicate Rows: ' || CAST((SELECT count(*) FROM a) - (SELECT count(*) FROM b) AS VARCHAR) AS output
        UNION ALL SELECT 'Lineitem_Dropping_Small_Rows', 'Small Rows: ' || CAST((SELECT count(*) FROM b WHERE l_quantity < 2) AS VARCHAR)
        UNION ALL SELECT 'Lineitem', 'Rows: ' || CAST((SELECT count(*) FROM b WHERE l_quantity >= 2) AS VARCHAR)""",
    "mapped_batches": "SELECT p_partkey, upper(p_name) AS p_name FROM part",
    "owner_operator_counts": f"""WITH {STATIONS},
        a AS (SELECT owner AS company, count(*) AS n FROM st WHERE owner IS NOT NULL GROUP BY 1),
        b AS (SELECT company, count(*) AS n FROM (SELECT trim(unnest(string_split(companies, ';'))) AS company FROM st)
              WHERE company <> '' GROUP BY 1),
        w AS (SELECT coalesce(a.company, b.company) AS company, coalesce(a.n, 0) AS o, coalesce(b.n, 0) AS p
              FROM a FULL JOIN b ON a.company = b.company)
        SELECT company, greatest(o, p) AS max_count, 'owner_stations' AS type, o AS stations FROM w
        UNION ALL SELECT company, greatest(o, p), 'operator_stations', p FROM w""",
    "top_stations_null_year": f"""WITH {STATIONS},
        p AS (SELECT bahnhof_lang, coalesce(jahr, 2018) AS jahr, verkehr FROM st),
        q AS (SELECT * FROM p WHERE jahr IN (2018, 2022)),
        b AS (SELECT bahnhof_lang, max(verkehr) AS max_value FROM q GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
        SELECT bahnhof_lang, jahr, verkehr, max_value FROM q JOIN b USING (bahnhof_lang)""",
    "stations_per_canton": f"""WITH {STATIONS} SELECT code, name, count(*) AS n FROM st
        JOIN (VALUES {_NAMES}) AS c(code, name) ON kanton = code GROUP BY 1, 2""",
    "share_per_canton": f"""WITH {STATIONS} SELECT kanton, named, stations, round(named * 100.0 / stations, 4) AS percent
        FROM (SELECT kanton, count(owner) AS named, count(*) AS stations FROM st WHERE kanton IS NOT NULL GROUP BY 1) WHERE named > 0""",
}
