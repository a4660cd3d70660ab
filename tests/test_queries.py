"""Every core query beside its SQL on the smallest tables."""

import pytest

from compare import compare, connect
from reelframe.plans import core_queries

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(D)


@pytest.mark.parametrize("name", list(core_queries.QUERIES))
def test_query(spark, con, name):
    ok, said = compare(spark, con, D, core_queries.QUERIES[name], core_queries.SQL.get(name))
    assert ok, said


def test_sql_belongs_to_queries():
    assert set(core_queries.SQL) <= set(core_queries.QUERIES)


def test_entry_without_the_optional_package():
    import __spark_entry__ as entry

    assert set(core_queries.QUERIES) <= set(entry.queries()) and set(core_queries.SQL) <= set(entry.oracle_sql())
