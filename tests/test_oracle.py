"""Every SQL-checkable registered query equals its DuckDB twin on sf0.001."""

import pytest

import __spark_entry__ as entry
from quarry.plans.parity import compare, duck_connection

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_small):
    return duck_connection(sf_small)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_small, duck, name):
    got = entry.queries()[name](spark, sf_small).toPandas()
    want = duck.execute(SQL[name]).df()
    res = compare(got, want)
    assert res["same_columns"], (sorted(got.columns), sorted(want.columns))
    assert res["rows"][0] == res["rows"][1]
    assert res["exact"], res


@pytest.mark.parametrize("name", sorted(SQL))
def test_schema_is_stable_between_calls(spark, sf_small, name):
    q = entry.queries()[name]
    assert q(spark, sf_small).schema == q(spark, sf_small).schema
