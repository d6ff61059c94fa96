"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import pytest
from oracle import check, connect

from casequarry.plans import core_queries, downstream_queries, eval_queries, stream_queries, text_queries

SF = "/root/testdata/sf0.001"
MODULES = (core_queries, text_queries, eval_queries, downstream_queries, stream_queries)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: s for m in MODULES for name, s in m.ORACLE_SQL.items()}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    check(QUERIES[name](spark, SF), con, SQL[name])


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
