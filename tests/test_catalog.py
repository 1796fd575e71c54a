from functools import cache

import pytest

import __spark_entry__ as entry_module
from catalog import queries
from catalog.check import compare, connect
from catalog.oracles import oracles

SF = "/root/testdata/sf0.001"
SQL = oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module", autouse=True)
def train_once():
    """Queries about one trained model share the run here; outside the tests each trains its own."""
    single, queries._run = queries._run, cache(queries._run)
    yield
    queries._run = single


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries.QUERIES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["label", "precision", "recall", "f1", "support"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF, queries.QUERIES[name], SQL[name])
    assert ok, note
