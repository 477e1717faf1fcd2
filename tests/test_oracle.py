"""Every registered query against its DuckDB SQL on the driver's tables."""

import oracle
import pytest

import __spark_entry__ as entry
from tidemark.plans.suite import REGISTRY

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(entry.queries()) and set(REGISTRY) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, duck, name):
    columns, rows, types = oracle.actual(entry.queries()[name](spark, FOLDER))
    want_columns, want_rows, want_types = oracle.expected(duck, entry.oracle_sql()[name])
    assert columns == want_columns
    assert rows == want_rows and rows
    assert {c: TYPES[t] for c, t in types.items()} == want_types
