import contextlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tramline.session import build_session
    s = build_session("local[4]", app_name="tramline-tests", shuffle_partitions=4)
    yield s
    s.stop()


@contextlib.contextmanager
def broadcasts(spark, allowed):
    """Joins inside may broadcast a small side, or none may."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "10m" if allowed else "-1")
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
