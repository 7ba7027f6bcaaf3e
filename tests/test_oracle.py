"""Every catalogue query against its DuckDB oracle (sf0.001, whole tables)."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    problems, _, _ = compare(spark, con, name, E.queries()[name], SQL[name], SF)
    assert not problems, problems


def test_rows_only_queries_run(spark):
    for name in sorted(set(E.queries()) - set(SQL)):
        assert E.queries()[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"social_media", "sentiment", "share"}
