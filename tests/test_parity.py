"""Every registered query with an oracle agrees with DuckDB at sf0.01."""

import os

import pytest

import caprank.plans.lifecycle  # noqa: F401
import oracle
from caprank.plans.registered import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = oracle.compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_every_oracle_is_sql_that_runs(con):
    import __spark_entry__ as e

    for name, sql in e.oracle_sql().items():
        assert isinstance(sql, str), name
        con.execute(sql)
