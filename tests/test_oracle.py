"""Every query with SQL gives its rows at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from docloom.plans.registry import ORACLE, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables here")


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    def cell(x: object) -> str:
        if x is None or x is pd.NA or x is pd.NaT or x != x:
            return ""
        if isinstance(x, bool) or not hasattr(x, "__index__"):
            return f"{x:.9g}" if isinstance(x, float) else str(x)
        return str(int(x))

    return sorted(tuple(cell(x) if not isinstance(x, float) or not float(x).is_integer() else str(int(x)) for x in r) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, str(DATA)).toPandas()
    if name not in ORACLE:
        assert len(got)
        return
    expected = duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)
