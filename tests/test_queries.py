"""Every registered query against its SQL counterpart on the smallest sample."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SAMPLE_TABLES

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}
# Questions whose thresholds are meant for larger samples.
MAY_BE_EMPTY = {"shop_brand_except", "shop_brand_except_by_brand", "shop_high_cost_brands", "shop_loyal_high_revenue"}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in SAMPLE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(contract.own_queries()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(contract.own_queries()))
def test_query_equals_sql(name, spark, folder, duck):
    df = contract.queries()[name](spark, folder)
    answer = duck.execute(contract.oracle_sql()[name])
    sql_types = {column[0]: str(column[1]) for column in answer.description}
    assert {c: SAME_TYPE[t] for c, t in df.dtypes} == sql_types

    columns = sorted(sql_types)
    at = {column: i for i, column in enumerate(sql_types)}
    expected = sorted((tuple(row[at[c]] for c in columns) for row in answer.fetchall()), key=repr)
    got = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    assert len(got) == len(expected)
    for mine, theirs in zip(got, expected):
        for a, b in zip(mine, theirs):
            assert a == b or (isinstance(a, float) and math.isclose(a, b, rel_tol=1e-12))
    assert got or name in MAY_BE_EMPTY


def test_flagship(spark):
    assert contract.entry(spark).count() == 15
