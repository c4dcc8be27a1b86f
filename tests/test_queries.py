"""Registered queries against their SQL, and properties of their plans."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF, plan_of
from tools.check_sql import TABLES, rows_of

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "stats_clusters"])
def test_query(spark, database, name):
    df = QUERIES[name](spark, SF)
    found = rows_of(df.columns, df.collect())
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        cursor = database.execute(SQL[name])
        assert found == rows_of([d[0] for d in cursor.description], cursor.fetchall())
    else:
        assert found[1] == Counter(found[1]) and sum(found[1].values())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["c_custkey", "c_acctbal", "order_total"] and df.count() > 0


def test_reads_reach_the_scan(spark):
    plan = plan_of(QUERIES["fg_sql_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_acctbal), IsNotNull(c_mktsegment), GreaterThan(c_acctbal,5000.0)" in plan
    plan = plan_of(QUERIES["fg_feature"](spark, SF))
    assert "ReadSchema: struct<c_acctbal:double>" in plan
    plan = plan_of(QUERIES["trials_best_max"](spark, SF))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
