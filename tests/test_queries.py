"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from tools.check_oracles import multiset

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.skipif(not SF_DIR.exists(), reason="the test tables are absent")
@pytest.mark.parametrize("name", list(spark_entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    df = spark_entry.queries()[name](spark, str(SF_DIR))
    found = multiset([tuple(row) for row in df.collect()], df.columns)
    cursor = con.execute(spark_entry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert found == multiset(cursor.fetchall(), names)


def test_entry_gives_rows(spark):
    assert spark_entry.entry(spark).count() > 0
