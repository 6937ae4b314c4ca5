"""The queries. Each takes (spark, sf_dir) and returns a DataFrame."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import (
    month_of,
    parse_point,
    title_case_columns,
    year_of,
)
from ..operators import (
    add_population,
    join_top,
    keep_valid_locations,
    override_pairs,
    population_by_region,
    replace_values,
    rounded_totals,
    within_years,
)
from ..plans import (
    category_totals,
    cleanse_sales,
    full_refresh,
    land_sales,
    measures,
    prepare_population,
    region_mart,
    region_totals,
    summarise,
    top_categories,
    year_mart,
)
from ..sinks import save_table, stored, write_by_month, write_parquet
from ..presets import MONTH_COLUMN
from ..sources import read_parquet, read_table, typed
from ..storage import scratch_path
from . import star

BEGIN, END = star.YEARS

# Rules for the test tables. The second city rule feeds the last pair rule.
COUNTY_RULES = {"NATION_1": "Nation One", "NATION_2": "O'NATION", "nation_3": "never matched"}
CITY_RULES = {"HOUSEHOLD": "HOUSE-HOLD", "MACHINERY": "MACHINE  TOWN"}
PAIR_RULES = {
    ("FURNITURE", "NATION_3"): "NATION_9",
    ("BUILDING", "O'NATION"): "MCNATION",
    ("MACHINE  TOWN", "NATION_4"): "NATION_8",
}
EXCLUDED = "NATION_5"


def mart_year_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = within_years(star.table(spark, sf_dir, "lineitem"), BEGIN, END, "l_shipdate")
    rows = lines.select(
        year_of(F.col("l_shipdate")).alias("sale_year"), F.col("l_quantity").alias("sold_liters")
    )
    return year_mart(rows, BEGIN, END)


def mart_category_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Lines add up per part before the join: one row per part is sorted and joined, and a
    # part with very many lines shrinks on the map side.
    lines = within_years(star.table(spark, sf_dir, "lineitem"), BEGIN, END, "l_shipdate")
    per_part = lines.groupBy("l_partkey").agg(F.sum("l_quantity").alias("sold_liters"))
    parts = star.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("category_name")
    )
    rows = per_part.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return category_totals(rows)


def population_by_region_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population_by_region(star.population(spark, sf_dir, star.YEARS), BEGIN, END)


def region_totals_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As above: lines add up per order, and the same partitioning serves the join.
    lines = within_years(star.table(spark, sf_dir, "lineitem"), BEGIN, END, "l_shipdate")
    per_order = lines.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("liters"), F.sum("l_extendedprice").alias("dollars")
    )
    rows = per_order.join(
        star.order_regions(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey")
    )
    totals = rounded_totals(
        rows, ["county"], {"total_sold_liters": "liters", "total_sale_dollars": "dollars"}
    )
    people = population_by_region(star.population(spark, sf_dir, star.YEARS), BEGIN, END)
    return add_population(totals, people, "county")


def top_category_per_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = top_categories(measures(star.sales(spark, sf_dir)), rank_column="row_order")
    return best.select(
        "county",
        "category_name",
        F.round("sold_liters").alias("total_sold_liters"),
        F.col("row_order").cast("int").alias("row_order"),
    )


def mart_region_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_mart(
        measures(star.sales(spark, sf_dir)), star.population(spark, sf_dir, star.YEARS), BEGIN, END
    )


def region_totals_with_top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both sides of the join read a written summary, so the sales are read once.
    rows = summarise(measures(star.sales(spark, sf_dir)))
    summary = stored(rows, scratch_path(spark, "sales-summary"))
    ranked = top_categories(summary, rank_column="row_order").drop("sold_liters")
    return join_top(region_totals(summary, BEGIN, END), ranked, "county", "row_order")


def _customer_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return star.customer_regions(spark, sf_dir).select(
        "c_custkey",
        F.when(balance < 0, "").when(balance < 9000, F.col("c_mktsegment")).alias("city"),
        F.when(F.col("county") == "NATION_7", "")
        .when(F.col("county") == "NATION_8", F.lower("county"))
        .when(F.col("county") != "NATION_9", F.col("county"))
        .alias("county"),
    )


def filter_invalid_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid_locations(_customer_locations(spark, sf_dir), excluded_county="NATION_8")


def repair_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = star.table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    types = replace_values(parts, "p_type", {"PROMO": "Promotion", "small": "never matched"})
    return replace_values(types, "p_brand", {"Brand#1": "Brand#25", "Brand#25": "O'Brand"})


def repair_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"
    )
    rules = {
        ("F", "1-URGENT"): "1-Late",
        ("O", "5-LOW"): "4-NOT SPECIFIED",
        ("o", "2-HIGH"): "never matched",
    }
    return override_pairs(orders, rules, city="o_orderstatus", county="o_orderpriority")


def repair_from_rule_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rules that are data: nations of two regions take the region's name, and customer
    # segments with a rich customer override their nation.
    regions = star.table(spark, sf_dir, "region").filter(F.col("r_regionkey") <= 1)
    county_rules = (
        star.table(spark, sf_dir, "nation")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_name", "r_name")
    )
    pair_rules = (
        star.customer_regions(spark, sf_dir)
        .groupBy("c_mktsegment", "county")
        .agg(F.max("c_acctbal").alias("richest"))
        .filter("richest > 9500")
        .select("c_mktsegment", "county", F.concat(F.lit("RICH "), "county").alias("new"))
    )
    locations = _customer_locations(spark, sf_dir)
    return override_pairs(replace_values(locations, "county", county_rules), pair_rules)


def title_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    def names(table: str, key: str, *columns: str) -> DataFrame:
        raw = star.table(spark, sf_dir, table).select(
            F.lit(table).alias("source"),
            F.col(key).cast("long").alias("id"),
            F.concat_ws("  ", *columns).alias("name"),
        )
        return title_case_columns(raw, ["name"])

    return (
        names("orders", "o_orderkey", "o_orderpriority")
        .unionByName(names("customer", "c_custkey", "c_mktsegment", "c_name"))
        .unionByName(names("part", "p_partkey", "p_type", "p_name", "p_brand"))
    )


def title_case_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return title_case_columns(
        star.table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"]
    )


def title_case_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = star.table(spark, sf_dir, "conversations")
    return title_case_columns(turns.select("conv_id", "turn", "role", "text"), ["role", "text"])


def _show_day(df: DataFrame) -> DataFrame:
    return df.withColumn("sale_date", F.date_format("sale_date", "yyyy-MM-dd"))


def cleansed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = star.full_sales(spark, sf_dir)
    return _show_day(cleanse_sales(raw, COUNTY_RULES, CITY_RULES, PAIR_RULES, EXCLUDED))


def prepared_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv = scratch_path(spark, "population-csv")
    star.write_csv(star.population_text(spark, sf_dir), csv)
    return prepare_population(spark, csv, with_point=True).select(
        "fips",
        "county",
        "year",
        "population",
        F.col("primary_point.lon").alias("lon"),
        F.col("primary_point.lat").alias("lat"),
    )


def landed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv = scratch_path(spark, "sales-csv")
    star.write_csv(star.sales_text(spark, sf_dir), csv)
    return _show_day(stored(land_sales(spark, csv), scratch_path(spark, "landed-sales")))


def typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("string")
    priority = F.col("o_orderpriority")
    raw = star.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.when(priority == "2-HIGH", "#N/A")
        .when(priority == "4-NOT SPECIFIED", "n/a")
        .when(priority == "1-URGENT", "1.#QNAN")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("number"),
        F.when(priority == "5-LOW", "NULL")
        .when(priority == "1-URGENT", F.concat(F.lit(" "), price, F.lit(" ")))
        .otherwise(price)
        .alias("price"),
        F.when(priority == "3-MEDIUM", "NA").when(priority != "5-LOW", priority).alias("note"),
    )
    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("number", T.LongType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("note", T.StringType()),
        ]
    )
    return typed(raw, schema)


def parsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "M/d/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "MMMM d yyyy"))
    )
    raw = star.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), text.alias("at")
    )
    schema = T.StructType(
        [T.StructField("o_orderkey", T.LongType()), T.StructField("at", T.TimestampNTZType())]
    )
    parsed = typed(raw, schema, ["M/d/yyyy", "MMMM d yyyy"])
    return parsed.select(
        "o_orderkey",
        F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"),
        year_of(F.col("at")).alias("year"),
        F.date_format(month_of(F.col("at")), "yyyy-MM-dd").alias("month"),
    )


def parsed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    lon_lat = F.concat_ws(" ", balance.cast("string"), nation.cast("string"))
    spelled = F.concat(F.lit("POINT ("), lon_lat, F.lit(")"))
    text = F.when(nation == 3, "").when(nation != 4, spelled)
    points = star.table(spark, sf_dir, "customer").select(
        "c_custkey", parse_point(text).alias("point")
    )
    return points.select("c_custkey", "point.lon", "point.lat")


def sales_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sales-by-month")
    # Stored, so that the joins run once and not for the sample as well.
    sales = stored(star.sales(spark, sf_dir), scratch_path(spark, "sales"))
    write_by_month(
        sales,
        path,
        cluster_columns=["county", "category_name"],
        last_keys=["sale_date", "sale_dollars"],
        rows_per_file=50_000,
    )
    kept = within_years(read_parquet(spark, path), BEGIN, END, "sale_date", MONTH_COLUMN)
    month = F.date_format("sale_month", "yyyy-MM-dd").alias("sale_month")
    return rounded_totals(
        kept,
        [month, "county"],
        {"total_sold_liters": "volume_sold_liters", "total_sale_dollars": "sale_dollars"},
        digits=2,  # cents: sums of doubles are not exact enough to round halves of a dollar
    )


def loaded_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, stored = scratch_path(spark, "population"), scratch_path(spark, "dim-population")
    people = star.population(spark, sf_dir).select(
        "fips", "county", "year", "population", F.lit("").alias("primary_point")
    )
    write_parquet(people, files)
    declared = read_parquet(spark, files, schemas.POPULATION)
    name = f"dim_population_{uuid.uuid4().hex}"
    save_table(declared.filter("year < 1997"), name, stored)
    save_table(declared, name, stored)
    loaded = read_table(spark, name).drop("primary_point")
    # The files stay for the returned frame; only the catalog entry goes.
    spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": name})
    return loaded


def all_marts_after_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales_csv = scratch_path(spark, "refresh-sales-csv")
    population_csv = scratch_path(spark, "refresh-population-csv")
    star.write_csv(star.sales_text(spark, sf_dir), sales_csv)
    star.write_csv(star.population_text(spark, sf_dir), population_csv)
    database = f"refreshed_{uuid.uuid4().hex}"
    spark.sql("CREATE DATABASE IDENTIFIER(:name)", args={"name": database})
    full_refresh(
        spark,
        sales_csv,
        population_csv,
        scratch_path(spark, "warehouse"),
        BEGIN,
        END,
        COUNTY_RULES,
        CITY_RULES,
        PAIR_RULES,
        EXCLUDED,
        database=database,
    )
    marts = ["dm_total_county_sale", "dm_total_year_sale", "dm_total_category_sale"]
    county, year, category = (
        read_table(spark, f"{database}.{name}").withColumn("mart", F.lit(name)) for name in marts
    )
    # The frames are resolved to the files; only the catalog entries go.
    spark.sql("DROP DATABASE IDENTIFIER(:name) CASCADE", args={"name": database})
    return county.unionByName(year, allowMissingColumns=True).unionByName(
        category, allowMissingColumns=True
    )


QUERIES = {
    "mart_year_totals": mart_year_totals,
    "mart_category_totals": mart_category_totals,
    "mart_region_totals": mart_region_totals,
    "population_by_region": population_by_region_query,
    "region_totals_enriched": region_totals_enriched,
    "top_category_per_region": top_category_per_region,
    "region_totals_with_top_category": region_totals_with_top_category,
    "filter_invalid_locations": filter_invalid_locations,
    "repair_values": repair_values,
    "repair_pairs": repair_pairs,
    "repair_from_rule_tables": repair_from_rule_tables,
    "title_case_names": title_case_names,
    "title_case_documents": title_case_documents,
    "title_case_conversations": title_case_conversations,
    "cleansed_sales": cleansed_sales,
    "prepare_population": prepared_population,
    "csv_landing_roundtrip": landed_sales,
    "typed_columns": typed_columns,
    "parsed_dates": parsed_dates,
    "parse_point": parsed_points,
    "partitioned_table_roundtrip": sales_by_month,
    "loaded_dimension": loaded_dimension,
    "full_refresh": all_marts_after_refresh,
}
