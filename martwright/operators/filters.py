"""Row filters, written so that they reach the Parquet scan."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import literal_like
from ..presets import EXCLUDED_COUNTY


def keep_valid_locations(
    df: DataFrame,
    city: str = "city",
    county: str = "county",
    excluded_county: str = EXCLUDED_COUNTY,
) -> DataFrame:
    """Drop rows with an empty or missing city or county, and the excluded county.

    The comparison is case-sensitive and a NULL never passes.
    """
    return df.filter(
        (F.col(city) != "") & (F.col(county) != "") & (F.col(county) != excluded_county)
    )


def within_years(
    df: DataFrame, begin: int, end: int, time_column: str, month_column: str | None = None
) -> DataFrame:
    """Rows of the years ``begin`` to ``end``, both inclusive.

    A half-open range on the stored column instead of ``year(column)``, which could not be
    pushed down. For a table partitioned by month name its ``month_column`` too and the range
    goes there: years begin and end with a month, so the result is the same and whole folders
    are skipped.
    """
    column = month_column or time_column
    kind = df.schema[column].dataType
    first = literal_like(f"{begin:04d}-01-01", kind)
    after = literal_like(f"{end + 1:04d}-01-01", kind)
    return df.filter((F.col(column) >= first) & (F.col(column) < after))
