"""Every registered query against its SQL twin, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from martwright.workload.oracle import ORACLES
from martwright.workload.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
WRITES_FILES = {
    "full_refresh",
    "csv_landing_roundtrip",
    "loaded_dimension",
    "prepare_population",
    "region_totals_with_top_category",
    "partitioned_table_roundtrip",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def canonical(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    picked = [tuple(row[i] for i in order) for row in data]
    return sorted(names), sorted(picked, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    found = canonical(df.columns, [tuple(row) for row in df.collect()])
    twin = duck.execute(contract.oracle_sql()[name])
    expected = canonical([c[0] for c in twin.description], twin.fetchall())
    assert found[1]
    assert found == expected


def test_entry(spark):
    assert contract.entry(spark).count() == 25
