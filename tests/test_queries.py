"""Every registered query against its SQL."""

import __spark_entry__ as entry
import oracle
import pytest
from obslake.plans import all_queries, all_sql

QUERIES, SQL = entry.queries(), entry.oracle_sql()
EMPTY_AT_SMALL_SCALE = {"literal_containment"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    diff = oracle.compare(df, con, SQL[name])
    if name in EMPTY_AT_SMALL_SCALE:
        diff = [d for d in diff if d != "EMPTY"]
    assert not diff, "\n".join(diff)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["entity", "obs_month", "lhs", "rhs", "rel_error", "passed"]
    assert df.count() > 0


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(all_queries()) == set(all_sql())
