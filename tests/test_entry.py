"""Registered queries against DuckDB on the smallest data, where it is there."""

from __future__ import annotations

import math
import os
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return int(v) if v == int(v) else round(v, 6)
    if getattr(v, "shape", None):
        return tuple(plain(x) for x in v.tolist())
    return plain(v.item()) if hasattr(v, "item") else str(v) if hasattr(v, "isoformat") else v


def canonical(df):
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return con


OWN = [n for n in entry.oracle_sql() if not n.startswith(("p3", "p5", "p6", "p7", "p8", "p9"))]


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, DATA).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
