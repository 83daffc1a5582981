"""Every registered query against its SQL counterpart, on the whole sf0.01 tables."""

import pytest

from oreline.plans.registry import ORACLE, QUERIES
from tests.compare import connect, duck_rows, duck_types, spark_rows, spark_types

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(ROOT)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, ROOT)
    names, rows = spark_rows(result)
    expected_names, expected = duck_rows(duck, ORACLE[name])
    assert names == expected_names
    assert spark_types(result) == duck_types(duck)
    assert len(rows) == len(expected)
    differing = [(a, b) for a, b in zip(rows, expected) if a != b]
    assert not differing, differing[:3]
    assert rows, "a query without rows proves nothing"


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
