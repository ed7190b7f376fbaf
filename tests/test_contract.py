"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from check_oracles import compare, connect
from conftest import SF

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    got, want, _, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert got == want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["kpi_date", "route_id", "route_short_name"] and df.count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
