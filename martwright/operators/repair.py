"""Value repair by rules.

Rules come as a dictionary or, when they are data themselves, as a rule table. Either way they are
joined, so neither types nor errors depend on their number: key, target and rule columns are texts,
each key has one rule, and every rule has a new value. Matching is exact and case-sensitive; rows
without a matching rule, and NULLs, stay as they are. A rule table is computed once and written to
the shared folder, so that what was checked is what is joined.
"""

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import stored
from ..storage import scratch_path

# Rules are broadcast only if their texts are known to stay below both limits.
BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_ROWS = 1_000_000


def replace_values(df: DataFrame, column: str, rules: Mapping[str, str] | DataFrame) -> DataFrame:
    """Replace whole values: ``{old: new}`` or a table with columns (old, new)."""
    if isinstance(rules, DataFrame):
        return _apply_table(df, [column], column, rules)
    return _apply_rules(df, [column], column, [((old,), new) for old, new in rules.items()])


def override_pairs(
    df: DataFrame,
    rules: Mapping[tuple[str, str], str] | DataFrame,
    city: str = "city",
    county: str = "county",
) -> DataFrame:
    """Set the county where (city, county) has a rule: ``{(city, county): new county}`` or
    a table with columns (city, county, new county)."""
    if isinstance(rules, DataFrame):
        return _apply_table(df, [city, county], county, rules)
    return _apply_rules(df, [city, county], county, list(rules.items()))


def _apply_rules(
    df: DataFrame, keys: Sequence[str], target: str, rules: Sequence[tuple[tuple[str, ...], str]]
) -> DataFrame:
    """A dictionary is a rule table whose keys are unique and whose size is known already."""
    _check_texts(df, {*keys, target})
    if not rules:
        return df
    texts = [(*key, new) for key, new in rules]
    if any(not isinstance(text, str) for row in texts for text in row):
        raise ValueError("a rule needs a text for every key and a new value")
    columns = {f"c{i}": pa.array(column, pa.string()) for i, column in enumerate(zip(*texts))}
    # From Arrow it is a relation that the planner holds: broadcasting it starts no job.
    table = df.sparkSession.createDataFrame(pa.table(columns))
    size = sum(len(text.encode()) for row in texts for text in row)
    return _join_rules(df, keys, target, table, _may_broadcast(len(texts), size))


def _apply_table(df: DataFrame, keys: Sequence[str], target: str, rules: DataFrame) -> DataFrame:
    """Columns of ``rules`` count by position: the keys in order, then the new value."""
    if len(rules.columns) != len(keys) + 1:
        raise ValueError(f"a rule table for {list(keys)} needs {len(keys) + 1} columns")
    _check_texts(df, {*keys, target})
    _check_texts(rules, set(rules.columns))
    kept = stored(
        rules.toDF(*(f"c{i}" for i in range(len(keys) + 1))),
        scratch_path(df.sparkSession, "rules"),
    )
    return _join_rules(df, keys, target, kept, _is_small(kept))


def _check_texts(df: DataFrame, columns: set[str]) -> None:
    others = sorted(c for c in columns if not isinstance(df.schema[c].dataType, T.StringType))
    if others:
        raise ValueError(f"rules repair text columns; not text: {', '.join(others)}")


def _join_rules(
    df: DataFrame, keys: Sequence[str], target: str, rules: DataFrame, broadcast: bool
) -> DataFrame:
    """Left join with checked rules, under names that no caller has."""
    mark = uuid.uuid4().hex
    *rule_keys, value = names = [f"rule_{mark}_{i}" for i in range(len(keys) + 1)]
    rules = rules.toDF(*names)
    if broadcast:
        rules = F.broadcast(rules)
    # Without the hint both sides are shuffled on the keys and adaptive execution splits
    # the partitions of frequent keys.
    matches = reduce(
        lambda left, right: left & right,
        (F.col(key) == F.col(rule_key) for key, rule_key in zip(keys, rule_keys)),
    )
    return (
        df.join(rules, matches, "left")
        .withColumn(target, F.coalesce(F.col(value), F.col(target)))
        .drop(*names)
    )


def _may_broadcast(rows: int, text_bytes: int) -> bool:
    return rows <= BROADCAST_ROWS and text_bytes <= BROADCAST_BYTES


def _is_small(rules: DataFrame) -> bool:
    """Check stored rules in one distributed pass that returns a single row: each key has one
    rule, no rule is without a new value. Tells whether they may be broadcast."""
    *keys, value = rules.columns
    text_bytes = reduce(
        lambda left, right: left + right,
        (F.coalesce(F.octet_length(F.col(name)), F.lit(0)) for name in rules.columns),
    )
    per_key = rules.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(text_bytes.cast("long")).alias("bytes"),
        F.bool_or(F.col(value).isNull()).alias("no_value"),
    )
    found = per_key.agg(
        F.sum("rows").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.max("rows").alias("repeats"),
        F.bool_or("no_value").alias("no_value"),
        F.max_by(F.concat_ws(", ", *keys), "rows").alias("example"),
    ).first()
    if (found["repeats"] or 0) > 1:
        raise ValueError(f"more than one rule for the same key, for example ({found['example']})")
    if found["no_value"]:
        raise ValueError("a rule has no new value")
    return _may_broadcast(found["rows"] or 0, found["bytes"] or 0)
