"""Grouped, rounded aggregates."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sums import exact_sums


def rounded_totals(
    df: DataFrame, keys: Sequence[str | Column], sums: Mapping[str, str | Column], digits: int = 0
) -> DataFrame:
    """Sum per group, the same for every order of the rows; rounding comes last and halves go away
    from zero."""
    totals = exact_sums(df, keys, sums)
    return totals.withColumns({name: F.round(F.col(f"`{name}`"), digits) for name in sums})


def population_by_region(
    population: DataFrame, begin: int, end: int, region: str = "county"
) -> DataFrame:
    """Average and sum over the years of a (region, fips, year, population) table."""
    return (
        population.filter(F.col("year").between(begin, end))
        .groupBy(region, "fips")
        .agg(
            F.round(F.avg("population")).alias("avg_population"),
            F.round(F.sum("population").cast("double")).alias("sum_population"),
        )
    )


def add_population(totals: DataFrame, regional_population: DataFrame, region: str) -> DataFrame:
    """Join per-region totals with per-region population on the region name.

    The totals are aggregated already, so both sides have one row per region (and fips) and
    the fact table itself is never joined. Regions without population drop out; a region
    name with two fips codes gives two rows.
    """
    return totals.join(regional_population, region, "inner")
