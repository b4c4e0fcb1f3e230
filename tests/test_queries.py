"""Every registered query against its oracle on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, connect

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, small, duck, name):
    problems, _ = compare(QUERIES[name](spark, small), duck, ORACLES[name])
    assert not problems, "\n".join(problems)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
