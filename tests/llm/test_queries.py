"""Queries against their DuckDB SQL, and what every query has in common."""

import inspect

import oracle
import pytest
from helpers import SMALL

import __spark_entry__ as entry
from tidemark.llm.suite import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SMALL)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, duck, name):
    columns, rows, _ = oracle.actual(QUERIES[name](spark, SMALL))
    want_columns, want_rows, _ = oracle.expected(duck, ORACLES[name])
    assert columns == want_columns
    assert rows == want_rows and rows


def test_operators_import_only_the_library():
    import tidemark.llm.suite as suite

    assert "ImportError" not in inspect.getsource(suite)
