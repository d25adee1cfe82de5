"""Rows of a query and of its reference SQL, column by column."""

from pathlib import Path

import duckdb

from tests.conftest import SF_DIR


def duck(sf_dir=SF_DIR):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def assert_same(frame, sql, connection=None):
    theirs = (connection or duck()).execute(sql)
    names = [c[0] for c in theirs.description]
    assert sorted(frame.columns) == sorted(names)
    expected = sorted(map(repr, theirs.fetchall()))
    actual = sorted(repr(tuple(row[n] for n in names)) for row in frame.collect())
    assert len(actual) == len(expected) > 0
    assert actual == expected
