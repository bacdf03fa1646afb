"""Every registered query against the same question in plain SQL, on whole tables."""

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry
from tripmart.oracle import oracle_queries as oracle_sql
from tripmart.registry import sample_queries as queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
EXPECT_EMPTY = {"integrity_duplicate_keys"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(frame.itertuples(index=False, name=None), key=repr)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, duck, name):
    actual = queries()[name](spark, SF_DIR).toPandas()
    expected = duck.execute(oracle_sql()[name]).df()
    assert sorted(actual.columns) == sorted(expected.columns)
    assert rows(actual) == rows(expected)
    assert (len(actual) == 0) == (name in EXPECT_EMPTY)


def test_entry_has_rows(spark):
    assert entry(spark).count() == 10
