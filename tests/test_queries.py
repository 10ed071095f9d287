"""Every registered query against its SQL twin on the smallest driver tables."""

import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_queries import normal  # noqa: E402
from starfold.queries import QUERIES  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    frame = queries()[name](spark, str(SF_DIR))
    got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = duck.execute(oracle_sql()[name])
    assert got == normal([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
