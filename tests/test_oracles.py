"""Every registered query against DuckDB over the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def normalised(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(
            None
            if pd.isna(v)
            else round(float(v), 6)
            if isinstance(v, float)
            else str(v)[:10]
            if hasattr(v, "isoformat")
            else str(v)
            for v in row
        )
        for row in frame.itertuples(index=False)
    ]
    return sorted(rows, key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    ours = contract.queries()[name](spark, SF_DIR).toPandas()
    theirs = duck.execute(contract.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(theirs) > 0
    assert normalised(ours) == normalised(theirs)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.partition_value for r in rows] == ["2024-01-10", "2024-01-11", "2024-01-12"]
    assert all(r.rows_read == r.rows_before == r.rows_after > 0 for r in rows)
