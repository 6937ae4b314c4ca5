from .cleanse import cleanse_sales
from .landing import land_sales, prepare_population
from .ledger import current_tables
from .marts import (
    SalesRoles,
    category_mart,
    category_totals,
    measures,
    region_mart,
    region_totals,
    summarise,
    top_categories,
    year_mart,
)
from .refresh import TABLES, full_refresh

__all__ = [
    "SalesRoles",
    "TABLES",
    "category_mart",
    "category_totals",
    "cleanse_sales",
    "current_tables",
    "full_refresh",
    "land_sales",
    "measures",
    "prepare_population",
    "region_mart",
    "region_totals",
    "summarise",
    "top_categories",
    "year_mart",
]
