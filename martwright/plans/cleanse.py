"""Cleansing of landed sales."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from .. import presets
from ..functions import title_case_columns
from ..operators import keep_valid_locations, override_pairs, replace_values

Rules = Mapping | DataFrame


def cleanse_sales(
    sales: DataFrame,
    county_rules: Rules = presets.COUNTY_RULES,
    city_rules: Rules = presets.CITY_RULES,
    pair_rules: Rules = presets.CITY_COUNTY_RULES,
    excluded_county: str = presets.EXCLUDED_COUNTY,
    title_cased: Iterable[str] = presets.TITLE_CASED_COLUMNS,
) -> DataFrame:
    """Filter, repair and title-case, without a shuffle.

    The order decides the result: the filter sees raw text, the pair rules see replaced
    counties and cities, and every rule is matched before title-casing.
    """
    valid = keep_valid_locations(sales, excluded_county=excluded_county)
    counties = replace_values(valid, "county", county_rules)
    cities = replace_values(counties, "city", city_rules)
    return title_case_columns(override_pairs(cities, pair_rules), title_cased)
