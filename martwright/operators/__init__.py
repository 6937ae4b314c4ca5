from .filters import keep_valid_locations, within_years
from .ranking import join_top, top_per_group
from .repair import override_pairs, replace_values
from .sums import exact_sums
from .totals import add_population, population_by_region, rounded_totals

__all__ = [
    "add_population",
    "exact_sums",
    "join_top",
    "keep_valid_locations",
    "override_pairs",
    "population_by_region",
    "replace_values",
    "rounded_totals",
    "top_per_group",
    "within_years",
]
