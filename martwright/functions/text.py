"""Repairs for the raw population file."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .casts import strict_cast


def remove_literal(value: Column, literal: str) -> Column:
    """Remove every occurrence of a literal text."""
    return F.replace(value, F.lit(literal), F.lit(""))


def trailing_year(value: Column, label: str = "year") -> Column:
    """The last four characters as a number. Missing or bad text raises."""
    year = strict_cast(F.right(value, F.lit(4)), T.LongType(), label)
    return F.coalesce(year, F.raise_error(F.lit(f"{label}: missing")))


def count_or_zero(value: Column, label: str = "count") -> Column:
    """A whole number, fractions cut off; missing counts as 0, bad text raises."""
    number = strict_cast(value, T.DoubleType(), label).cast("long")
    return F.coalesce(number, F.lit(0))
