"""The registered queries of this package on whole tables, beside their SQL where there is one."""

import os

import pytest

import __spark_entry__ as contract
from rubrica.llm.queries import QUERIES
from tests.test_registered_queries import SF_DIR, canonical, duck  # noqa: F401

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_query(spark, duck, name):  # noqa: F811
    result = contract.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    rows = sorted(tuple(canonical(v) for v in r) for r in result.select(*columns).collect())
    assert rows
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    order = [names.index(c) for c in columns]
    assert sorted(names) == columns
    assert rows == sorted(tuple(canonical(r[i]) for i in order) for r in cursor.fetchall())
