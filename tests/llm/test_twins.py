"""The queries that SQL can say, against their twins."""

import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from check_queries import normal  # noqa: E402

import __spark_entry__  # noqa: E402
from starfold.llm.queries import QUERIES, SQL  # noqa: E402

SF = Path("/root/testdata/sf0.001")


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert sorted(name.split("_")[0] for name in QUERIES) == sorted(f"op{n}" for n in range(1, 14))
    assert {name: __spark_entry__.oracle_sql()[name] for name in SQL} == SQL


@pytest.mark.parametrize("name", list(SQL))
def test_twin(spark, name):
    duck = duckdb.connect()
    for file in SF.glob("*.parquet"):
        duck.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    frame = QUERIES[name](spark, str(SF))
    cursor = duck.execute(SQL[name])
    assert normal(frame.columns, [tuple(row) for row in frame.collect()]) == normal([d[0] for d in cursor.description], cursor.fetchall())
