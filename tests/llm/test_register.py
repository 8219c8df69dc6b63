"""Registered queries against their SQL in DuckDB, on the smallest test tables."""

import pytest

from starbuild.llm.queries import ORACLE, QUERIES
from tests.compare import differences, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, small, name):
    assert differences(QUERIES[name](spark, small), duck(small), ORACLE[name]) == []


def test_names():
    assert ORACLE.keys() <= QUERIES.keys()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
