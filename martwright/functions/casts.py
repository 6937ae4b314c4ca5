"""Strict typing of text columns: a value either converts or fails the job.

The checks are explicit, so they hold whether or not the session runs in ANSI mode.
"""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import presets

# Java accepts a type suffix and hexadecimal floats as numbers; a CSV must not contain them.
JAVA_ONLY_NUMBER = r"(?i)(?<!in)[df]\b|0x"


def text_or_empty(value: Column) -> Column:
    """Text columns have no missing values: an empty field is the empty string."""
    return F.coalesce(value, F.lit(""))


def null_if_token(value: Column, tokens: Sequence[str] = presets.NULL_TOKENS) -> Column:
    """NULL for the listed texts, the value otherwise."""
    return F.when(~value.isin(*tokens), value)


def _or_fail(text: Column, converted: Column, kind: str, label: str) -> Column:
    message = F.concat(F.lit(f"{label}: not a valid {kind}: '"), text, F.lit("'"))
    return F.when(text.isNotNull(), F.coalesce(converted, F.raise_error(message)))


def strict_cast(value: Column, kind: T.DataType, label: str = "value") -> Column:
    """Cast text; NULL stays NULL, any other text that does not convert raises."""
    converted = value.try_cast(kind)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        converted = F.when(~F.rlike(value, F.lit(JAVA_ONLY_NUMBER)), converted)
    return _or_fail(value, converted, kind.simpleString(), label)


def timestamp_or_null(value: Column, patterns: Sequence[str]) -> Column:
    """Zone-free timestamp of the first matching pattern. In ANSI mode a text that matches
    none raises, otherwise it gives NULL."""
    if not patterns:
        raise ValueError("give at least one timestamp pattern")
    text = F.ltrim(value)
    converted = F.to_timestamp_ntz(text, F.lit(patterns[-1]))
    for pattern in reversed(patterns[:-1]):
        matches = F.try_to_timestamp(text, F.lit(pattern)).isNotNull()
        converted = F.when(matches, F.to_timestamp_ntz(text, F.lit(pattern))).otherwise(converted)
    return converted
