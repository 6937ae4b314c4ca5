"""One key holds a third of all lines: results stay whole and the joins split the key."""

import duckdb
import pytest
from pyspark.sql import functions as F

from martwright.workload.oracle import ORACLES
from martwright.workload.registry import QUERIES

from .conftest import plan_text
from .test_queries import TABLES, canonical

SOURCE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module", params=["l_partkey", "l_orderkey", "o_custkey"])
def skewed(request, spark, tmp_path_factory):
    """The tables, with one value in a third of the rows of one key column."""
    folder, column = tmp_path_factory.mktemp("skew"), request.param
    for name in TABLES:
        df = spark.read.parquet(f"{SOURCE}/{name}.parquet")
        if column in df.columns:
            hot = F.rand(1) < 0.34
            df = df.withColumn(column, F.when(hot, F.lit(7).cast("long")).otherwise(F.col(column)))
        df.repartition(16 if name in ("lineitem", "orders") else 1).write.parquet(
            str(folder / f"{name}.parquet")
        )
    return str(folder), column


@pytest.mark.parametrize(
    "name",
    ["mart_region_totals", "region_totals_enriched", "mart_category_totals", "top_category_per_region"],
)
def test_hot_key(spark, conf, skewed, name):
    folder, _ = skewed
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    # At this size whole stages would be merged into one task, which leaves nothing to split.
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    twin = duck.execute(ORACLES[name])
    expected = canonical([c[0] for c in twin.description], twin.fetchall())
    df = QUERIES[name](spark, folder)
    found = canonical(df.columns, [tuple(row) for row in df.collect()])
    assert len(found[1]) == len(expected[1]) > 0
    for mine, other in zip(found[1], expected[1]):
        assert mine == pytest.approx(other, abs=1.0)  # sums that end in .5 may round either way
    if name in ("mart_region_totals", "top_category_per_region"):
        assert "SortMergeJoin(skew=true)" in plan_text(df)
