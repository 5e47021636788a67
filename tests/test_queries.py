"""Every query against its SQL in DuckDB, over the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from checks import registry
from checks.compare import compare

FOLDER = Path("/root/testdata/sf0.001")
registry.load_all()


@pytest.fixture(scope="module")
def tables(spark):
    return registry.Tables(spark, str(FOLDER))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(tables, duck, name):
    df = registry.QUERIES[name](tables)
    assert len(set(df.columns)) == len(df.columns)
    rows = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    assert rows
    if name in registry.SQL:
        assert compare(df, rows, duck, registry.SQL[name]) == ""


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)
