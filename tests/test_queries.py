"""Every registered query against its SQL, on the smallest test tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from workload import ORACLES, QUERIES  # noqa: E402

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, str(DATA))
    expected = database.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    places = [expected.columns.index(c) for c in columns]
    left = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=str)
    right = sorted((tuple(r[i] for i in places) for r in expected.fetchall()), key=str)
    assert left == right
