"""Every registered query against its SQL, value by value."""

import math
from collections import Counter

import pytest

import __spark_entry__ as entry_module
from tests.conftest import DATA
from workload import oracle
from workload.queries import registered

QUERIES = registered()
SQL = oracle.statements()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(name, spark, duck):
    result = QUERIES[name](spark, DATA)
    expected = duck.execute(SQL[name])
    expected_columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(expected_columns)
    order = [expected_columns.index(c) for c in result.columns]
    want = Counter(tuple(plain(row[i]) for i in order) for row in expected.fetchall())
    got = Counter(tuple(plain(v) for v in row) for row in result.collect())
    assert sum(want.values()) > 0
    assert got == want


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith(("_replace", "_read", "_two_pages")) and "_job_" not in n])
def test_column_types_equal_sql(name, spark, duck):
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    types = {f.name: names[f.dataType.simpleString()] for f in QUERIES[name](spark, DATA).schema}
    assert types == {r[0]: r[1] for r in duck.execute("describe " + SQL[name]).fetchall()}


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
