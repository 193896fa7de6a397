"""Every query with SQL gives the same rows in both engines."""

import pytest
from compare import compare, connect

from clientgrain import catalog

catalog.load()


@pytest.fixture(scope="module")
def con(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_as_sql(spark, con, tiny, name):
    assert compare(catalog.QUERIES[name](spark, tiny), con, catalog.SQL[name]) == []


def test_every_query_is_registered_once():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
    assert len(catalog.SQL) >= 55


def test_entry(spark):
    import __spark_entry__ as entry_module
    assert entry_module.entry(spark).count() == 150
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
