import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from freshet.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[8]", app="tests")
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture
def table(spark):
    """table("k int, v double", [(1, 2.0)]) -> DataFrame"""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (all of them by default)."""
    got = [tuple(r) for r in df.collect()]
    keys = [df.columns.index(c) for c in order] or range(len(df.columns))
    return sorted(got, key=lambda r: tuple((r[i] is not None, r[i]) for i in keys))
