"""Every registered query against its SQL on the smallest tables."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
from sensorgrid.driver.oracles import SQL  # noqa: E402
from sensorgrid.driver.queries import QUERIES  # noqa: E402
from check_queries import rows_of  # noqa: E402

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    return connection


def test_which_queries_have_sql():
    assert set(QUERIES) == set(SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    got = entry.queries()[name](spark, DATA).toArrow()
    expected = db.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert rows_of(got) == rows_of(expected)
    types = [{f.name: str(f.type) for f in t.schema} for t in (got, expected)]
    assert types[0] == types[1]


def test_entry(spark):
    assert entry.entry(spark).count() == 10
