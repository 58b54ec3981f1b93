"""Every raster query against its DuckDB SQL."""

from pathlib import Path

import duckdb
import pytest

from tilewright.plans.oracles import ORACLE_SQL
from tilewright.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).iterdir():
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows(frame):
    plain = lambda v: None if v is None or v != v else int(v) if isinstance(v, float) and v == int(v) else v
    cols = sorted(frame.columns)
    return cols, sorted(map(str, frame[cols].map(plain).itertuples(index=False, name=None)))


def test_all_have_oracles():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(ORACLE_SQL[name]).df())
