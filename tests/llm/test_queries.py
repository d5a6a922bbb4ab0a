"""Registered queries against their SQL on the smallest tables, and shapes of the others."""

import pytest

import __spark_entry__ as entry
from holdfast.llm import queries as llm
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_against_sql(spark, connection, name):
    assert differences(llm.QUERIES[name](spark, FOLDER), connection, llm.ORACLE_SQL[name]) == []


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in llm.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(llm.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(llm.ORACLE_SQL) <= set(entry.oracle_sql())
