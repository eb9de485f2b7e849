"""Every registered query against its SQL in DuckDB, over whole tables."""

import os

import duckdb
import pytest

from shelfwise.plans import catalog, oracle

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def assert_no_cross_join(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    got = [tuple(row) for row in df.collect()]
    cursor = duck.execute(oracle.SQL[name])
    columns = [d[0] for d in cursor.description]
    wanted = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(wanted) > 0
    assert normal(got, df.columns) == normal(wanted, columns)
    assert_no_cross_join(df)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(oracle.SQL)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    assert df.count() > 0
    assert_no_cross_join(df)


def test_registry_and_sql_agree():
    assert set(oracle.SQL) <= set(catalog.QUERIES)
    assert os.path.exists(os.path.join(os.path.dirname(__file__), "..", "__spark_entry__.py"))
