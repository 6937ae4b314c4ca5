"""The queries that SQL can express, against DuckDB on the whole tables."""

import duckdb
import pytest

from martwright.llm.oracle import ORACLES
from martwright.llm.queries import QUERIES

from .conftest import SF_DIR, as_rows


@pytest.mark.parametrize("name", ORACLES)
def test_query_and_sql_agree(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    twin = connection.execute(ORACLES[name])
    columns = [c[0] for c in twin.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(as_rows(found, *columns), key=repr) == sorted(twin.fetchall(), key=repr)
