"""The full refresh: every table, in dependency order."""

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets
from ..sinks import ROWS_PER_FILE, publish_views, published, settle_views, stored, write_by_month, write_parquet
from ..sources import read_parquet
from ..storage import listed
from .cleanse import Rules, cleanse_sales
from .landing import land_sales, prepare_population
from .ledger import LEASE_SECONDS, Ledger, current_tables, make_current, retire
from .marts import category_mart, measures, region_mart, summarise, year_mart

TABLES = (
    "landed_sales",
    "dim_county_population",
    "fact_sales",
    "sales_summary",
    "dm_total_county_sale",
    "dm_total_year_sale",
    "dm_total_category_sale",
)


def full_refresh(
    spark: SparkSession,
    sales_csv: str | list[str],
    population_csv: str | list[str],
    root: str,
    begin: int = presets.BEGIN_YEAR,
    end: int = presets.END_YEAR,
    county_rules: Rules = presets.COUNTY_RULES,
    city_rules: Rules = presets.CITY_RULES,
    pair_rules: Rules = presets.CITY_COUNTY_RULES,
    excluded_county: str = presets.EXCLUDED_COUNTY,
    database: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    keep_refreshes: int | None = None,
    lease_seconds: float = LEASE_SECONDS,
) -> dict[str, str]:
    """Land, cleanse and load the two files, then build the marts. Returns the path of every table.

    Each refresh writes to its own folder under ``root``: tables of the last run stay readable while
    this one works, and nothing is read and replaced at the same time. When all tables are finished,
    ``current_tables(spark, root)`` names them, and with ``database``, which must exist, so do the
    catalog names: each of the two switches all seven in one step.

    Every finished table is marked. A refresh that died is continued by the next one with the same
    request, that is the same input files (by name, length and time), rules and arguments: finished
    tables are not built again. It is taken over at once if its driver could still say that it failed,
    else when its lease of ``lease_seconds`` has run out.

    ``keep_refreshes`` is the number of finished refreshes, this one included, whose folders stay; older
    ones under ``root`` and abandoned ones are deleted after the switch, but none that another driver
    works in and none that is current. The default keeps all: a reader of an old path, or a view in
    another database, may still need them.

    The marts share one written summary, so the sales table is scanned once for all three.
    """
    if keep_refreshes is not None and keep_refreshes < 1:
        raise ValueError("keep at least this refresh")
    if database is not None and not spark.catalog.databaseExists(database):
        raise ValueError(f"there is no database {database}")
    root = root.rstrip("/")
    request = _request(
        spark, sales_csv, population_csv, begin, end,
        [county_rules, city_rules, pair_rules], excluded_county, rows_per_file,
    )

    with Ledger.open(spark, root, request, lease_seconds) as ledger:
        paths = {name: f"{ledger.folder}/{name}" for name in TABLES}

        def table(name: str, write: Callable[[str], object]) -> DataFrame:
            if not ledger.is_done(name):
                ledger.check()
                write(paths[name])
                ledger.done(name)
            return read_parquet(spark, paths[name])

        def cleansed() -> DataFrame:
            return cleanse_sales(landed, county_rules, city_rules, pair_rules, excluded_county)

        landed = table("landed_sales", lambda path: stored(land_sales(spark, sales_csv), path))
        population = table(
            "dim_county_population", lambda path: stored(prepare_population(spark, population_csv), path)
        )
        fact = table("fact_sales", lambda path: write_by_month(cleansed(), path, rows_per_file=rows_per_file))
        summary = table("sales_summary", lambda path: stored(summarise(measures(fact)), path))
        table(
            "dm_total_county_sale",
            lambda path: write_parquet(region_mart(summary, population, begin, end), path),
        )
        table("dm_total_year_sale", lambda path: write_parquet(year_mart(summary, begin, end), path))
        table("dm_total_category_sale", lambda path: write_parquet(category_mart(summary, begin, end), path))

        make_current(spark, root, paths)
        if database is not None:
            publish_views(spark, database, paths)
        ledger.finish()
        if keep_refreshes is not None:
            if database is not None:
                settle_views(spark, database)
            retire(spark, root, keep_refreshes, _protected(spark, root, database))
    return paths


def _protected(spark: SparkSession, root: str, database: str | None) -> set[str]:
    """Folders of what readers are shown just now."""
    shown = [current_tables(spark, root)]
    if database is not None:
        shown.append((published(spark, database) or {"paths": {}})["paths"])
    return {path.rpartition("/")[0] for paths in shown for path in paths.values()}


def _request(
    spark: SparkSession,
    sales_csv: str | list[str],
    population_csv: str | list[str],
    begin: int,
    end: int,
    rules: list[Rules],
    excluded_county: str,
    rows_per_file: int,
) -> str:
    """What a refresh was asked to do, as text: equal texts give equal tables."""
    inputs = [[p] if isinstance(p, str) else list(p) for p in (sales_csv, population_csv)]
    return json.dumps(
        {
            "sales": listed(spark, inputs[0]),
            "population": listed(spark, inputs[1]),
            "years": [begin, end],
            "rules": [_rule_print(r) for r in rules],
            "excluded_county": excluded_county,
            "rows_per_file": rows_per_file,
        }
    )


def _rule_print(rules: Rules) -> object:
    """Rules as they are; of a rule table its number of rows and a checksum that no order changes."""
    if not isinstance(rules, DataFrame):
        return sorted(([key] if isinstance(key, str) else list(key), new) for key, new in rules.items())
    row = F.xxhash64(*rules.columns)
    found = rules.agg(F.count(F.lit(1)), F.bit_xor(row), F.sum(row.cast("decimal(38,0)"))).first()
    return [str(value) for value in found]
