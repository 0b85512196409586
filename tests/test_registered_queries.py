"""Every registered query runs on whole tables and agrees with its SQL on another engine."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from rubrica.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool) or isinstance(value, str):
        return str(value)
    if isinstance(value, (list, tuple)):
        return str([canonical(v) for v in value])
    return repr(round(float(value), 9) + 0.0)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    rows = sorted(tuple(canonical(v) for v in r) for r in result.select(*columns).collect())
    assert rows
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted(tuple(canonical(r[i]) for i in order) for r in cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
