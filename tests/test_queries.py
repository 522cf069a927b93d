"""Every registered query against its SQL twin on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="session")
def con(sf):
    return oracle.connect(sf)


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_names():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        result = oracle.compare(df, con, SQL[name])
        # One day of the smallest tables may have no rows; the larger ones are checked by check_queries.py.
        assert result.startswith("ok") or result == "EMPTY", result
    else:
        df.collect()
