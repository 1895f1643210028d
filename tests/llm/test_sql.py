"""Registered queries of the training-data operators against their SQL, value by value."""

from collections import Counter

import pytest

from footfall.llm import oracle, queries
from tests.conftest import DATA

SQL = oracle.statements()


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(name, spark, duck):
    result = queries.registered()[name](spark, DATA)
    expected = duck.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    order = [columns.index(c) for c in result.columns]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    assert Counter(map(tuple, result.collect())) == want


def test_all_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [n for n in range(1, 14) if any(x.startswith(f"op{n}_") for x in names)] == list(range(1, 14))
    assert "pipeline" in names
