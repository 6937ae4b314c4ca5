"""Sums of doubles that no order of addition changes.

Adding doubles rounds at every step, so a distributed sum depends on how rows met. Here every value is
cut into whole numbers of fixed weights first: six digits of 23 bits, from 2^56 down to 2^-82. Whole
numbers add up exactly in any order and combine before the shuffle like any other sum; only the total
is made a double again, once per group.

A value of at least 2^-29 is represented in full. Of smaller ones what is below 2^-83 is rounded, which
is no matter of order either. Values of 2^56 and more, infinities and NaN are added as doubles. A group
may have 2^40 rows.
"""

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 23
# Powers of 2 that the digits are multiples of.
WEIGHTS = tuple(33 - BITS * k for k in range(6))
TOO_LARGE = 2.0 ** (WEIGHTS[0] + BITS)


def exact_sums(
    df: DataFrame, keys: Sequence[str | Column], sums: Mapping[str, str | Column], *others: Column
) -> DataFrame:
    """The keys, then a double for each of ``sums`` (null where a group has no value), then ``others``:
    further aggregates of the same groups, with aliases. They may use any column of ``df``."""
    mark = uuid.uuid4().hex[:8]
    values = [f"value_{mark}_{i}" for i in range(len(sums))]
    columns = [F.col(c) if isinstance(c, str) else c for c in sums.values()]
    rows = df.withColumns({v: c.cast("double") for v, c in zip(values, columns)})
    digits = {name: rule for v in values for name, rule in _digits(v).items()}
    cut = rows.withColumns({name: F.expr(rule) for name, rule in digits.items()})
    groups = cut.groupBy(*keys).agg(*(F.expr(f"sum({name}) AS {name}") for name in digits), *others)
    others_at = len(groups.columns) - len(others)
    return groups.select(
        *_named(groups.columns[: len(keys)]),
        *(F.expr(_total(v)).alias(name) for name, v in zip(sums, values)),
        *_named(groups.columns[others_at:]),
    )


# Rules as SQL text: they are long, and text takes one call to the JVM instead of one per operator.
def _digits(value: str) -> dict[str, str]:
    rules = {f"{value}_large": f"IF(abs({value}) >= {TOO_LARGE!r}D, {value}, NULL)"}
    before = ""
    for k, weight in enumerate(WEIGHTS):
        # Whole multiples of this weight, less those that the digits before hold. Both are whole and
        # near each other, so the difference is exact.
        whole = f"rint({value} * {2.0**-weight!r}D)"
        rules[f"{value}_{k}"] = f"IF(abs({value}) < {TOO_LARGE!r}D, CAST({whole}{before} AS BIGINT), NULL)"
        before = f" - {whole} * {2.0**BITS!r}D"
    return rules


def _total(value: str) -> str:
    """The sum as a double. Three digits are one number of up to 38 decimals."""

    def together(first: int) -> str:
        high, middle, low = (f"CAST({value}_{k} AS DECIMAL(19, 0))" for k in range(first, first + 3))
        number = f"({high} * {2**BITS} + {middle}) * {2**BITS} + {low}"
        return f"CAST({number} AS DOUBLE) * {2.0 ** WEIGHTS[first + 2]!r}D"

    total = f"({together(0)} + {together(3)})"
    return f"coalesce({total} + {value}_large, {total}, {value}_large)"


def _named(columns: Sequence[str]) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]
