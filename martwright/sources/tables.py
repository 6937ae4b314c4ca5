"""Parquet and catalog scans."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Parquet files, optionally under a declared schema instead of the stored one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the session catalog."""
    return spark.table(name)
