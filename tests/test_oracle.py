"""Every registered query of the chat tables against its SQL, on the smallest given tables."""

import inspect

import pytest
from pyspark.sql import DataFrame

import __spark_entry__ as entry_module
from workload.compare import connect, difference
from workload.oracle import ORACLE as SQL
from workload.queries import REGISTRY as QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql_and_every_sql_a_query():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, QUERIES[name], SQL[name], SF) is None


def test_entry(spark):
    df = entry_module.entry(spark)
    assert isinstance(df, DataFrame)
    assert df.columns == ["category_name", "query_text", "keyword", "created_at", "query_count"]
    assert df.count() > 0


def test_entry_registers_them():
    assert QUERIES.items() <= entry_module.queries().items() and SQL.items() <= entry_module.oracle_sql().items()
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_queries_take_session_and_folder():
    for fn in entry_module.queries().values():
        assert len(inspect.signature(fn).parameters) == 2
