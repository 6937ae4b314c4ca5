"""Exact duplicates of texts, blanks aside. Built-in functions only.

Texts are equal when they are identical after deleting every space and ASCII control from tab to
carriage return. Rows are grouped by the 128-bit hash of that form *and* by the form itself, so a
group is exact: the hash spreads and finds, the comparison of bytes inside it keeps collisions apart.
The aggregation combines before the shuffle, so a text that a third of all rows share leaves each
task as one row; rows find their group again over hashes alone, in a join that adaptive execution may
split.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS

# One sortable number for (more code points, then smaller id): both fit a decimal of 38 digits, and
# numbers, unlike structs, aggregate in place.
STEP = Decimal(10) ** 20
HALF = Decimal(5) * Decimal(10) ** 19
SHIFT = Decimal(10) ** 19


def without_blanks(text: Column) -> Column:
    """One pass per blank, each a search of bytes; ``translate`` looks every character up."""
    plain = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        plain = F.replace(plain, F.lit(blank), F.lit(""))
    return plain


def _number(value: Decimal) -> Column:
    return F.lit(value).cast("decimal(38,0)")


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points stays, then the one with the smallest id. A
    null text is empty, and empty texts are equal. A null id comes after all others. Rows that
    repeat an id with an equal text of the same length stand or fall together. An empty table gives
    an empty result; other columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.length(text).alias("points"),
        without_blanks(F.col(text_column)).alias("plain"),
    )
    shifted = F.coalesce(F.col("doc_id").cast("decimal(38,0)"), _number(SHIFT)) + _number(SHIFT)
    order = F.col("points").cast("decimal(38,0)") * _number(STEP) + _number(HALF) - shifted
    digest = F.unhex(F.md5("plain")).alias("hash")
    groups = (
        rows.select(digest, "plain", order.cast("decimal(38,0)").alias("order"))
        .groupBy("hash", "plain")
        .agg(F.max("order").alias("best"), F.count(F.lit(1)).alias("group_size"))
    )
    back = (_number(HALF) - F.col("best") % _number(STEP) - _number(SHIFT)).cast("decimal(38,0)")
    groups = groups.select(
        F.col("hash").alias("group_hash"),
        F.unhex(F.sha2("plain", 256)).alias("group_sha"),
        F.when(back < _number(SHIFT), back.cast("long")).alias("keep_id"),
        (F.col("best") / _number(STEP)).cast("int").alias("most_points"),
        "group_size",
    )
    # Two different texts with equal hashes differ in the second hash; which group a row belongs to
    # was decided on the bytes.
    members = rows.select(
        "doc_id", "points", digest, F.unhex(F.sha2("plain", 256)).alias("sha")
    ).join(
        groups, (F.col("hash") == F.col("group_hash")) & (F.col("sha") == F.col("group_sha"))
    )
    return members.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("most_points"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
