import datetime as dt
import random

import numpy as np
import pytest

from tramline.operators import describe as Dm
from tramline.operators import timegrid as G


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        ts = base + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400))
        rows.append((ts, rnd.choice(["a", "b", "c"]), float(rnd.randrange(0, 3))))
    return spark.createDataFrame(rows, "ts timestamp, kind string, v double")


def _brute(events_rows, step):
    slots = {int(r[0].replace(tzinfo=dt.timezone.utc).timestamp()) // step for r in events_rows}
    lo, hi = min(slots), max(slots)
    return lo, hi, [s for s in range(lo, hi + 1) if s not in slots]


def test_missing_slots_match_brute_force(spark, events):
    lo, hi, missing = _brute(events.collect(), 300)
    s = G.missing_summary(events, "ts", 300).first()
    assert (s.grid_slots, s.missing) == (hi - lo + 1, len(missing))
    for part in ("hour", "weekday", "month", "year"):
        total = sum(r.missing for r in G.missing_by(events, "ts", 300, part).collect())
        assert total == len(missing)  # each breakdown sums to the missing count


def test_grid_fill_counts_match_brute_force(spark, events):
    rows = events.collect()
    cells = {}
    for ts, kind, v in rows:
        key = (kind, int(ts.replace(tzinfo=dt.timezone.utc).timestamp()) // 300)
        cells[key] = cells.get(key, 0.0) + v
    slots = [k[1] for k in cells]
    grid = len({k[0] for k in cells}) * (max(slots) - min(slots) + 1)
    zero_before = sum(1 for v in cells.values() if v == 0)
    r = G.grid_fill_counts(events, "ts", 300, "kind", "v").first()
    assert (r.grid_cells, r.observed, r.zero_before, r.zero_after) == \
        (grid, len(cells), zero_before, zero_before + grid - len(cells))


def test_exact_quantiles_with_narrowing(spark, monkeypatch):
    rnd = np.random.default_rng(7)
    vals = np.concatenate([rnd.normal(100, 30, 3000).round(2), np.full(2000, 42.0), rnd.integers(0, 5, 500)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    monkeypatch.setattr(Dm, "WINDOW_ROWS", 50)       # force the sketch-narrowing rounds
    got = Dm.exact_quantiles(df, "x", [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0])
    want = np.quantile(vals, [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0])
    assert np.allclose(got, want, rtol=0, atol=1e-9)


def test_describe_one_row(spark):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in [1, 2, 3, 4, None]], "x double")
    r = Dm.describe(df, "x").first()
    assert (r["count"], r["mean"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)
    assert Dm.exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5]) == [None]


def test_grid_independent_of_session_time_zone(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1, 0, 1) + dt.timedelta(minutes=7 * i),) for i in range(100)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    before = [tuple(r) for r in G.missing_by(df, "ts", 300, "hour").orderBy("hour").collect()]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        after = [tuple(r) for r in G.missing_by(df, "ts", 300, "hour").orderBy("hour").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after and before[0][0] == 0


def test_describe_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    r = Dm.describe(df, "x").first()
    assert (r["count"], r["mean"], r["p50"], r["max"]) == (2, 2.0, 2.0, 3.0)


def test_describe_columns_numeric_only(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (3, 4.0, "b")], "i int, d double, s string")
    out = {r.column_name: (r["count"], r["mean"], r["max"]) for r in Dm.describe_columns(df).collect()}
    assert out == {"i": (2, 2.0, 3.0), "d": (2, 3.0, 4.0)}
