"""Data marts.

All marts work on *measures*: rows of (county, category_name, sale_year, sold_liters,
sale_dollars). ``measures`` projects them from any sales table, ``summarise`` adds them up
once per county, category and year. Sums of sums are sums, so every mart accepts either
form; rounding is always the last step.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import year_of
from ..operators import (
    add_population,
    exact_sums,
    population_by_region,
    rounded_totals,
    top_per_group,
    within_years,
)
from ..presets import BEGIN_YEAR, END_YEAR

REGION, CATEGORY, YEAR = "county", "category_name", "sale_year"
LITERS, DOLLARS = "sold_liters", "sale_dollars"


@dataclass(frozen=True)
class SalesRoles:
    """Which column of a sales table plays which part."""

    region: str = "county"
    category: str = "category_name"
    time: str = "sale_date"
    volume: str = "volume_sold_liters"
    amount: str = "sale_dollars"


def measures(
    sales: DataFrame, roles: SalesRoles = SalesRoles(), years: tuple[int, int] | None = None
) -> DataFrame:
    """Project a sales table to measures; ``years`` prunes the scan to those years."""
    if years is not None:
        sales = within_years(sales, *years, roles.time)
    return sales.select(
        F.col(roles.region).alias(REGION),
        F.col(roles.category).alias(CATEGORY),
        year_of(F.col(roles.time)).alias(YEAR),
        F.col(roles.volume).cast("double").alias(LITERS),
        F.col(roles.amount).cast("double").alias(DOLLARS),
    )


def summarise(rows: DataFrame) -> DataFrame:
    """One row per county, category and year: the only pass over the sales table that the
    three marts need."""
    return exact_sums(rows, [REGION, CATEGORY, YEAR], {LITERS: LITERS, DOLLARS: DOLLARS})


def _in_years(begin: int, end: int):
    return F.col(YEAR).between(begin, end)


def _known(amount: str) -> Column:
    """An amount to rank by: one that is not a number ranks with the missing ones, last."""
    return F.nullif(F.col(amount), F.lit(float("nan")))


def year_mart(rows: DataFrame, begin: int = BEGIN_YEAR, end: int = END_YEAR) -> DataFrame:
    """Liters per year."""
    return rounded_totals(
        rows.filter(_in_years(begin, end)), [YEAR], {"total_sold_liters": LITERS}
    )


def category_mart(rows: DataFrame, begin: int = BEGIN_YEAR, end: int = END_YEAR) -> DataFrame:
    """Liters per category. Missing and empty category names are groups of their own."""
    return category_totals(rows.filter(_in_years(begin, end)))


def category_totals(rows: DataFrame) -> DataFrame:
    """The category mart of rows that are limited to its years already."""
    return rounded_totals(rows, [CATEGORY], {"total_sold_liters": LITERS})


def region_totals(rows: DataFrame, begin: int = BEGIN_YEAR, end: int = END_YEAR) -> DataFrame:
    """Liters and dollars per county."""
    return rounded_totals(
        rows.filter(_in_years(begin, end)),
        [REGION],
        {"total_sold_liters": LITERS, "total_sale_dollars": DOLLARS},
    )


def top_categories(rows: DataFrame, n: int = 1, rank_column: str | None = None) -> DataFrame:
    """The first ``n`` categories of every county over *all* years, by unrounded liters, most
    first, then by category name so that ties have one answer."""
    order = [F.desc_nulls_last(_known(LITERS)), F.asc_nulls_first(CATEGORY)]
    sold = exact_sums(rows, [REGION, CATEGORY], {LITERS: LITERS})
    return top_per_group(sold, [REGION], order, n, rank_column)


def region_mart(
    rows: DataFrame,
    population: DataFrame,
    begin: int = BEGIN_YEAR,
    end: int = END_YEAR,
    zero_population: str = "raise",
) -> DataFrame:
    """Totals per county with population, liters per person and the top category.

    Totals cover the years ``begin`` to ``end``, the top category covers all years. One
    aggregation per county and category serves both, so the sales are read once. The top
    category is picked by an aggregate, not a window: it combines before the shuffle and
    never gathers a county's categories in one task.

    The ratio divides the rounded liters by the population summed over the years. A zero
    sum raises; ``zero_population="null"`` leaves the ratio empty instead.
    """
    if zero_population not in ("raise", "null"):
        raise ValueError("zero_population is 'raise' or 'null'")
    in_years = _in_years(begin, end)
    by_category = exact_sums(
        rows,
        [REGION, CATEGORY],
        {
            "all_liters": LITERS,
            "liters": F.when(in_years, F.col(LITERS)),
            "dollars": F.when(in_years, F.col(DOLLARS)),
        },
        F.bool_or(in_years).alias("sold_in_years"),
    )
    sold = _known("all_liters")
    most_first = F.struct(sold.isNull(), -sold, F.col(CATEGORY))
    by_region = (
        exact_sums(
            by_category,
            [REGION],
            {"total_sold_liters": "liters", "total_sale_dollars": "dollars"},
            F.bool_or("sold_in_years").alias("sold_in_years"),
            F.min_by(CATEGORY, most_first).alias(CATEGORY),
        )
        .filter("sold_in_years")
        .withColumns({name: F.round(name) for name in ("total_sold_liters", "total_sale_dollars")})
    )
    return with_ratio(
        add_population(by_region, population_by_region(population, begin, end), REGION),
        zero_population,
    )


def with_ratio(enriched: DataFrame, zero_population: str = "raise") -> DataFrame:
    """The columns of the region mart, from totals joined with population and category."""
    people = F.col("sum_population")
    ratio = F.when(people != 0, F.round(F.col("total_sold_liters") / people, 2))
    if zero_population == "raise":
        ratio = ratio.when(people == 0, F.raise_error(F.lit("a county's population is zero")))
    return enriched.select(
        REGION,
        "avg_population",
        "fips",
        "total_sold_liters",
        "total_sale_dollars",
        ratio.alias("liters_per_person"),
        CATEGORY,
    )
