"""Every registered query against its DuckDB oracle on the smallest driver
tables (the driver repeats this at sf0.01)."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tramline.plans.driver import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v + 0.0, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return v


def _sorted(recs, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in recs]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["yr", "column_name", "mismatches", "total_rows", "percent"]


def test_every_query_has_an_oracle():
    """Of the library's own queries; an optional part may register others."""
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = _sorted([r.asDict() for r in sdf.collect()], cols)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    want = _sorted([dict(zip(dcols, r)) for r in cur.fetchall()], cols)
    assert got == want
