"""Every registered query with an oracle matches DuckDB exactly on sf0.001."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle import compare

SQL = E.oracle_sql()
QUERIES = E.queries()


def test_every_query_is_registered_with_a_callable():
    assert QUERIES and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    r = compare(spark, duck, name, QUERIES[name], SQL[name], SF_SMALL)
    assert r["schema"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["exact"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "probability_alive" in df.columns
    assert df.count() > 0
