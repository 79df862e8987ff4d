"""Every registered query against its SQL, values and column names alike."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as registered

# The optional queries for training data have tests of their own.
OPTIONAL = re.compile(r"op\d+_|pipeline$")
QUERIES = {k: v for k, v in registered.queries().items() if not OPTIONAL.match(k)}
SQL = {k: v for k, v in registered.oracle_sql().items() if not OPTIONAL.match(k)}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS FROM '{path}'")
    yield connection
    connection.close()


def _rows(rows, names, columns) -> list[str]:
    """Values as the two engines' Python interfaces give them, columns by name."""
    places = [list(names).index(c) for c in columns]
    return sorted(repr([row[i] for i in places]) for row in rows)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    ours = QUERIES[name](spark, sf_dir)
    theirs = duck.sql(SQL[name])
    columns = sorted(theirs.columns)
    assert sorted(ours.columns) == columns
    assert _rows(ours.collect(), ours.columns, columns) == _rows(theirs.fetchall(), theirs.columns, columns)


def test_entry(spark):
    assert registered.entry(spark).count() > 0
