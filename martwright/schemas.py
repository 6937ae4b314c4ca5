"""Declared schemas. Names are positional: they replace the header of a CSV file."""

from pyspark.sql import types as T

_STRING, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# Column names, order and types of the sales file.
SALES = _schema(
    ("invoice_item_number", _STRING),
    ("sale_date", T.TimestampNTZType()),
    ("store_number", _LONG),
    ("store_name", _STRING),
    ("address", _STRING),
    ("city", _STRING),
    ("zip_code", _STRING),
    ("store_location", _STRING),
    ("county_number", _LONG),
    ("county", _STRING),
    ("category", _LONG),
    ("category_name", _STRING),
    ("vendor_number", _LONG),
    ("vendor_name", _STRING),
    ("item_number", _STRING),
    ("item_description", _STRING),
    ("pack", _LONG),
    ("bottle_volume_ml", _LONG),
    ("state_bottle_cost", _DOUBLE),
    ("state_bottle_retail", _DOUBLE),
    ("bottles_sold", _LONG),
    ("sale_dollars", _DOUBLE),
    ("volume_sold_liters", _DOUBLE),
    ("volume_sold_gallons", _DOUBLE),
)

# Column names, order and types of the population file.
POPULATION = _schema(
    ("fips", _LONG),
    ("county", _STRING),
    ("year", _LONG),
    ("population", _LONG),
    ("primary_point", _STRING),
)


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all strings: what a CSV scan delivers before typing."""
    return _schema(*((name, _STRING) for name in schema.names))
