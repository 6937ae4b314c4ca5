"""Sums that no order of the rows changes."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from martwright.operators import exact_sums, rounded_totals
from martwright.plans import category_mart, measures, region_mart, summarise, top_categories, year_mart

from .conftest import plan_text, rows, sorted_rows

LARGEST = 2.0**55.9


def exact(values):
    """The nearest double of the true sum."""
    total = sum((Fraction(v) for v in values), Fraction(0))
    return total.numerator / total.denominator


def values_of(kind, n, rng):
    return {
        "cents": lambda: round(rng.uniform(-500, 5000), 2),
        "halves": lambda: rng.randrange(-1000, 1000) / 2,
        "wide": lambda: rng.uniform(-1, 1) * 2.0 ** rng.randrange(-25, 55),
        "cancelling": lambda: rng.choice([1e15, -1e15, 1e-7, 0.1, -0.1]),
    }[kind]() if n is None else [values_of(kind, None, rng) for _ in range(n)]


@pytest.mark.parametrize("kind", ["cents", "halves", "wide", "cancelling"])
def test_the_same_bits_for_any_order_and_partitioning(spark, kind):
    rng = random.Random(kind)
    data = [(rng.choice("ab"), v) for v in values_of(kind, 4000, rng)]
    expected = {k: exact(v for g, v in data if g == k) for k in "ab"}
    found = []
    for parts in (1, 8, 97):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k string, v double").repartition(parts)
        found.append({r.k: r.total.hex() for r in exact_sums(df, ["k"], {"total": "v"}).collect()})
    assert found[0] == found[1] == found[2]
    for k, bits in found[0].items():
        assert float.fromhex(bits) == pytest.approx(expected[k], rel=2**-52, abs=1e-20)
        if kind in ("halves", "cents"):
            assert float.fromhex(bits) == expected[k]


def test_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    groups = {
        "none": [None, None], "some": [None, 0.1, 0.2], "zero": [0.0, -0.0], "large": [2.0**60, 1.0], "most": [LARGEST, -LARGEST, 0.5],
        "nan": [1.0, nan], "inf": [inf, 1.0], "both": [inf, -inf], "tiny": [1e-12, -3e-12], "least": [5e-324],
        "minus": [-0.001, -0.002], "carry": [2.0**23] * 5 + [-(2.0**33)] * 3, "max": [1.7976931348623157e308],
    }
    df = spark.createDataFrame([(k, v, 1) for k, vs in groups.items() for v in vs], "`my key` string, v double, n int")
    found = exact_sums(df, ["my key"], {"the total": "v", "twice": F.col("v") * 2}, F.sum("n").alias("n"))
    assert found.columns == ["my key", "the total", "twice", "n"]
    for k, total, twice, n in rows(found):
        known = [v for v in groups[k] if v is not None]
        assert n == len(groups[k])
        if not known:
            assert total is None and twice is None
        elif k in ("nan", "both"):
            assert math.isnan(total)
        elif k in ("inf", "max"):
            assert total == sum(known)
        elif k == "least":
            assert total == 0.0
        else:
            assert total == pytest.approx(exact(known), rel=2**-52, abs=2.0**-80)
    assert exact_sums(df.limit(0), ["my key"], {"v": "v"}).count() == 0
    whole = exact_sums(df.filter("`my key` = 'some'").select(F.col("n").alias("v")), [F.col("v").alias("k")], {"v": "v"})
    assert rows(whole) == [(1, 3.0)]


def test_halves_round_alike(spark):
    """The sum is one half in every order; adding doubles one by one would lose it in some."""
    values = [1e16 / 4, 0.25, -1e16 / 4, 0.25, 2.0] * 40
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("k", F.lit(1)).repartition(5)
        assert rows(rounded_totals(df, ["k"], {"t": "v"})) == [(1, 100.0)]
        half = df.unionByName(spark.createDataFrame([(0.5, 1)], "v double, k int"))
        assert rows(rounded_totals(half, ["k"], {"t": "v"})) == [(1, 101.0)]


def test_marts_do_not_depend_on_the_order(spark):
    rng = random.Random(5)
    data = [
        (f"r{rng.randrange(4)}", f"c{rng.randrange(6)}", rng.randrange(2010, 2016), rng.uniform(0, 1e6) * 10.0 ** rng.randrange(-9, 3), rng.randrange(1000) / 8)
        for _ in range(3000)
    ]
    people = spark.createDataFrame([(i, f"r{i}", 2012, 10 + i) for i in range(4)], "fips long, county string, year long, population long")
    found = []
    for parts in (1, 13):
        rng.shuffle(data)
        facts = spark.createDataFrame(
            data, "county string, category_name string, sale_year int, sold_liters double, sale_dollars double"
        ).repartition(parts)
        summary = summarise(facts)
        found.append(
            [
                sorted_rows(df)
                for df in (
                    summary, top_categories(facts), region_mart(facts, people, 2011, 2014),
                    region_mart(summary, people, 2011, 2014), year_mart(facts, 2011, 2014), category_mart(summary, 2011, 2014),
                )
            ]
        )
    assert found[0] == found[1]


def test_sums_combine_before_the_shuffle_in_one_stage(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") / 3).alias("v"))
    plan = plan_text(exact_sums(df, ["k"], {"v": "v", "w": F.col("v") * 2}))
    assert plan.count("Exchange") == 1 and plan.count("partial_sum") >= 12 and "Python" not in plan
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_measures_of_any_table_go_in(spark):
    sales = spark.createDataFrame([("a", "b", None, 1.5, 2.0)], "county string, category_name string, sale_date timestamp_ntz, volume_sold_liters double, sale_dollars double")
    assert rows(summarise(measures(sales))) == [("a", "b", None, 1.5, 2.0)]
