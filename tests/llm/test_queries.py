"""Every query of the package that has SQL against DuckDB."""

import duckdb
import pytest

import __spark_entry__
from tripmart.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    rows = sorted((tuple(r) for r in got.select(names).collect()), key=str)
    want = con.sql(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})").fetchall()
    assert rows == sorted(want, key=str)


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} < set(__spark_entry__.queries())
