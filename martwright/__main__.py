"""Run the full refresh as a Spark job:

    spark-submit --py-files martwright.zip martwright/__main__.py \\
        --sales <csv> --population <csv> --root <folder> [--database <name>]
"""

import argparse

from pyspark.sql import SparkSession

from martwright import presets
from martwright.plans import full_refresh


def main() -> None:
    parser = argparse.ArgumentParser(description="Land, cleanse and load sales, build the marts.")
    parser.add_argument("--sales", required=True, nargs="+", help="sales CSV files or folders")
    parser.add_argument("--population", required=True, nargs="+", help="population CSV files")
    parser.add_argument("--root", required=True, help="folder that receives the tables")
    parser.add_argument("--begin", type=int, default=presets.BEGIN_YEAR)
    parser.add_argument("--end", type=int, default=presets.END_YEAR)
    parser.add_argument("--database", help="also publish the tables under this database")
    parser.add_argument("--keep", type=int, help="refreshes that stay below the root; default all")
    options = parser.parse_args()

    spark = SparkSession.builder.appName("sales-refresh").getOrCreate()
    paths = full_refresh(
        spark,
        options.sales,
        options.population,
        options.root,
        options.begin,
        options.end,
        database=options.database,
        keep_refreshes=options.keep,
    )
    for name, path in paths.items():
        print(f"{name}\t{path}")
    spark.stop()


if __name__ == "__main__":
    main()
