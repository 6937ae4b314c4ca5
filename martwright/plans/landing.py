"""From raw CSV to typed columns."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets, schemas
from ..functions import count_or_zero, null_if_token, parse_point, remove_literal, trailing_year
from ..sources import land_csv, read_text_csv, typed


def land_sales(
    spark: SparkSession,
    path: str | list[str],
    timestamp_patterns: Sequence[str] = presets.SALES_DATE_PATTERNS,
) -> DataFrame:
    """The sales file under its declared schema. The path may name any extract of it."""
    return land_csv(spark, path, schemas.SALES, timestamp_patterns)


def clean_population(raw: DataFrame, county_suffix: str = " County") -> DataFrame:
    """Repair the text columns ``County``, ``Year`` and ``Population`` of the raw file."""
    known = raw.select(
        *(null_if_token(F.col(c), presets.POPULATION_NULL_TOKENS).alias(c) for c in raw.columns)
    )
    return known.withColumns(
        {
            "County": remove_literal(F.col("County"), county_suffix),
            "Year": trailing_year(F.col("Year"), "Year").cast("string"),
            "Population": count_or_zero(F.col("Population"), "Population").cast("string"),
        }
    )


def prepare_population(
    spark: SparkSession, path: str | list[str], with_point: bool = False
) -> DataFrame:
    """The population files, cleaned and typed by header name: ``Primary Point`` is
    ``primary_point``, in any order of the columns. A file without one of the names is rejected.

    ``with_point`` replaces the point text by a ``struct<lon, lat>``.
    """
    cleaned = clean_population(read_text_csv(spark, path))
    found = {name.strip().lower().replace(" ", "_"): name for name in cleaned.columns}
    missing = [name for name in schemas.POPULATION.names if name not in found]
    if missing:
        raise ValueError(f"the population file has no column {', '.join(missing)}")
    population = typed(
        cleaned.select(*(F.col(f"`{found[n]}`").alias(n) for n in schemas.POPULATION.names)),
        schemas.POPULATION,
        presets.POPULATION_DATE_PATTERNS,
    )
    if with_point:
        population = population.withColumn(
            "primary_point", parse_point(F.col("primary_point"), "primary_point")
        )
    return population
