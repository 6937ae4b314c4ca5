"""Sales-shaped views of the star schema the queries run on.

Region is the nation of the ordering customer, category the part type, sale date the ship
date, volume the quantity, amount the extended price, and population the number of
customers of a nation that ordered in a year.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import year_of
from ..operators import within_years
from ..sinks import without_leftovers
from ..sources import read_parquet

YEARS = (1996, 1999)
# Rows of about 200 bytes: files that are not split have 100 MB of text.
ROWS_PER_RAW_FILE = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation. Whether the nations are broadcast is left to the
    optimizer, which knows their size."""
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("fips"), F.col("n_name").alias("county")
    )
    customers = table(spark, sf_dir, "customer")
    return customers.join(nations, F.col("c_nationkey") == F.col("fips"))


def order_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's region: the narrow side that lines are joined with."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = customer_regions(spark, sf_dir).select("c_custkey", "county")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "county"
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five columns the marts read, one row per line. Orders meet customers before they
    meet lines, so that the long line table is shuffled for orders and parts only."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(order_regions(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "county",
            F.col("p_type").alias("category_name"),
            F.col("l_shipdate").alias("sale_date"),
            F.col("l_quantity").alias("volume_sold_liters"),
            F.col("l_extendedprice").alias("sale_dollars"),
        )
    )


def population(
    spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None
) -> DataFrame:
    """Customers per nation that ordered in a year: (fips, county, year, population).

    A customer's orders of a year collapse before any join, however many there are. ``years``
    limits the orders that are read; a filter on the computed year would not reach the scan.
    """
    orders = table(spark, sf_dir, "orders")
    if years is not None:
        orders = within_years(orders, *years, "o_orderdate")
    active = (
        orders.select("o_custkey", year_of(F.col("o_orderdate")).cast("long").alias("year"))
        .distinct()
    )
    customers = customer_regions(spark, sf_dir).select("c_custkey", "fips", "county")
    return (
        active.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("fips", "county", "year")
        .agg(F.count(F.lit(1)).alias("population"))
    )


def full_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 24 columns of the sales file, typed. Texts are upper-case and irregular, as in a
    raw file: empty cities, quotes, commas, double blanks, hyphens.

    Lines meet their orders before their parts, whose texts are longer and would be shuffled with them."""
    col = F.col
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customers = customer_regions(spark, sf_dir).select(
        "c_custkey",
        F.when(col("c_acctbal") < 0, "").otherwise(col("c_mktsegment")).alias("city"),
        "county",
        "fips",
    )
    parts = table(spark, sf_dir, "part")
    located = orders.join(customers, col("o_custkey") == col("c_custkey"))
    return (
        lines.join(located, col("l_orderkey") == col("o_orderkey"))
        .join(parts, col("l_partkey") == col("p_partkey"))
        .select(
            _text("INV-", col("l_orderkey"), "-", col("l_linenumber")).alias("invoice_item_number"),
            col("l_shipdate").alias("sale_date"),
            col("l_suppkey").alias("store_number"),
            _text("STORE-", col("o_orderpriority")).alias("store_name"),
            _text(F.upper("p_name"), "  ROAD").alias("address"),
            "city",
            F.lpad(col("fips").cast("string"), 5, "0").alias("zip_code"),
            _text("POINT (-", col("fips"), " ", col("p_size"), ")").alias("store_location"),
            col("fips").alias("county_number"),
            col("county"),
            col("p_size").cast("long").alias("category"),
            col("p_type").alias("category_name"),
            col("l_suppkey").alias("vendor_number"),
            _text("O'", F.upper("p_brand")).alias("vendor_name"),
            col("l_partkey").cast("string").alias("item_number"),
            _text("MC", F.upper("p_name"), ', "', col("p_brand"), '"').alias("item_description"),
            col("p_size").cast("long").alias("pack"),
            F.when(col("p_size") <= 45, col("p_size").cast("long") * 25).alias("bottle_volume_ml"),
            col("p_retailprice").alias("state_bottle_cost"),
            col("l_tax").alias("state_bottle_retail"),
            col("l_quantity").cast("long").alias("bottles_sold"),
            col("l_extendedprice").alias("sale_dollars"),
            col("l_quantity").alias("volume_sold_liters"),
            col("l_discount").alias("volume_sold_gallons"),
        )
    )


def sales_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``full_sales`` as a raw file spells it: dates as month/day/year, missing as ``NA``,
    other header names."""
    typed = full_sales(spark, sf_dir)
    spelled = typed.withColumns(
        {
            "sale_date": F.date_format("sale_date", "M/d/yyyy"),
            "bottle_volume_ml": F.coalesce(F.col("bottle_volume_ml").cast("string"), F.lit("NA")),
        }
    )
    return spelled.toDF(*(f"Raw {name}" for name in typed.columns))


def population_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``population`` as a raw file spells it. Year 1997 has no counts, and one county has
    two fips codes."""
    people = population(spark, sf_dir)
    fips = F.when(F.col("fips") == 6, F.array(F.lit(6), F.lit(106))).otherwise(F.array("fips"))
    counted = F.when(F.col("year") != 1997, F.col("population").cast("string"))
    return people.select(
        F.explode(fips.cast("array<long>")).alias("FIPS"),
        _text(F.initcap("county"), " County").alias("County"),
        _text("July 01 ", F.col("year")).alias("Year"),
        F.coalesce(counted, F.lit("NA")).alias("Population"),
        _text("POINT (-", F.col("fips"), ".5 ", F.col("year"), ")").alias("Primary Point"),
    )


def write_csv(df: DataFrame, path: str) -> None:
    """A raw file set, as input for landing. Its files are compressed, as raw sets of that size are, and
    of at most so many rows that one task reads one of them."""
    writer = df.write.option("header", True).option("escape", '"').option("compression", "gzip")
    with without_leftovers(df.sparkSession):
        writer.option("maxRecordsPerFile", ROWS_PER_RAW_FILE).csv(path)
