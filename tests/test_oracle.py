"""Every registered query against its DuckDB oracle on the smallest tables
(the round driver does the same at sf0.01), plus the entry smoke check."""

import pytest

import __spark_entry__ as E
from checks.compare import digest, duck

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == E.entry(spark).columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(SQL[name]).fetchdf()
    assert digest(got) == digest(want)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() > 0
