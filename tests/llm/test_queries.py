"""The queries of the subpackage against their SQL."""

import pytest

from catalog.check import compare, connect
from textmill.llm.queries import QUERIES
from textmill.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF, QUERIES[name], ORACLES[name])
    assert ok, note
