"""Every query of the subpackage on the smallest tables, beside its SQL where it has one."""

import pytest

from compare import compare, connect
from reelframe.llm import queries

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(D)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, con, name):
    ok, said = compare(spark, con, D, queries.QUERIES[name], queries.SQL.get(name))
    assert ok, said
    assert set(queries.SQL) <= set(queries.QUERIES)


COLUMNS = {
    "p2_found": "orig_index int, start_s int, speaker string",
    "p4_found": "tag_a string, tag_b string",
    "p5_found": "field string, term string, mark string",
    "p6_found": "track_a bigint, track_b bigint",
    "p8_found": "doc_id bigint, item_id int",
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_are_those_asked_for(spark, name):
    df = queries.QUERIES[name](spark, D)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
