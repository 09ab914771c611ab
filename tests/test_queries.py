"""Every registered query against its SQL, at the smallest scale."""

import pytest
from compare import connect, differences

import __spark_entry__ as registered
from patloom.queries import ORACLES as SQLS
from patloom.queries import QUERIES


@pytest.fixture(scope="module")
def connection(tables):
    return connect(tables)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, connection, name):
    assert differences(QUERIES[name](spark, tables), connection, SQLS[name]) == []


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQLS)
    assert set(QUERIES) <= set(registered.queries()) and set(SQLS) <= set(registered.oracle_sql())


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["doc_id", "chunk_pos", "chunk_text"]
    assert df.count() > 0
