"""Registered queries against their SQL, or for rows where SQL cannot say them, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from stowage.llm import registry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = [*registry.queries(), "pipeline"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    build, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql:
        assert compare(spark, con, name, build, sql, SF) is None
    else:
        assert build(spark, SF).count() > 0


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))
