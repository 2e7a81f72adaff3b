"""The registered queries: their oracle, where there is one, and one query for each operator."""

import glob

import duckdb
import pytest

from cohortflow.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {path.rsplit('/', 1)[1][:-8]} AS FROM '{path}'")
    got = queries.QUERIES[name](spark, SF)
    expected = con.execute(queries.ORACLES[name])
    assert sorted(c[0] for c in expected.description) == sorted(got.columns)
    order = [c[0] for c in expected.description]
    assert sorted(map(tuple, got.select(order).collect())) == sorted(expected.fetchall())
