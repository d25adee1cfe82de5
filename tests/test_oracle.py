"""Every query against its reference SQL on the whole test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from checks.oracle import oracle_queries
from tests.conftest import SF_DIR

QUERIES, ORACLES = entry._retail_queries(), oracle_queries()
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_reference_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(ORACLES[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    types = {c[0]: str(c[1]) for c in theirs.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in ours.schema} == types
    expected = _rows(columns, theirs.fetchall())
    actual = _rows(ours.columns, [tuple(row) for row in ours.collect()])
    assert len(actual) == len(expected) > 0
    assert actual == expected


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert {row.product_category for row in entry.entry(spark).collect()} == {
        "Electronics",
        "Fashion",
        "Grocery",
        "Sports",
    }
