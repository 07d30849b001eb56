"""Every registered query against its SQL, over the whole tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.01"
# Those of the training-data package have tests of their own.
QUERIES = {name: query for name, query in driver.queries().items() if query.__module__ == driver.__name__}
ORACLE = {name: text for name, text in driver.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = Counter(tuple(row) for row in result.select(*columns).collect())
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    quoted = ", ".join(f'"{column}"' for column in columns)
    theirs = Counter(duck.sql(f"SELECT {quoted} FROM ({ORACLE[name]})").fetchall())
    assert ours == theirs
    assert sum(ours.values()) > 0
    kinds = {"long": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
    spark_types = {f.name: kinds[f.dataType.typeName().replace("integer", "int").replace("bigint", "long")] for f in result.schema}
    assert spark_types == dict(zip(relation.columns, map(str, relation.types)))


def test_entry(spark):
    assert driver.entry(spark).count() > 0
