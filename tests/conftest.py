from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from foliograph.session import get_spark

    session = get_spark("tests", 4, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def f(df, *columns):
        out = df.select(*columns).collect() if columns else df.collect()
        return sorted((tuple(r) for r in out), key=repr)

    return f
