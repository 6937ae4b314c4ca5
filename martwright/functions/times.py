"""Calendar helpers that do not depend on the session time zone for zone-free columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def year_of(value: Column) -> Column:
    return F.year(value)


def month_of(value: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(value), "MM")


def literal_like(text: str, kind: T.DataType) -> Column:
    """A date literal in the type of the column it is compared with.

    Comparing with another type would cast the column, which blocks filter pushdown.
    """
    return F.lit(text).cast(kind)
