"""Every registered query runs, and agrees with its SQL where it has one."""

import duckdb  # noqa: F401
import pytest

import __spark_entry__ as registry
from compare import connect, differences

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_sql_text_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["b2_fit_blend", "b3_blend_predict", "m6_metadata", "m10_predict"])
def test_query_without_sql_returns_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_the_flagship_entry_runs(spark):
    row = registry.entry(spark).first()
    assert row["model"] == "Constant" and row["size"] > 0 and row["r2"] <= 0.2
