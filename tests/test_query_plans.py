"""What the registered queries must not do on large tables."""

import re

import pytest

from martwright.workload.registry import QUERIES

from .conftest import plan_text
from .test_queries import SF_DIR, WRITES_FILES

LAZY = sorted(set(QUERIES) - WRITES_FILES)
# Rules are broadcast once their size is known.
RULE_TABLES = {"repair_values": 2, "repair_pairs": 1, "repair_from_rule_tables": 2, "cleansed_sales": 3}


@pytest.fixture
def plan(spark, conf):
    conf("spark.sql.debug.maxToStringFields", "1000")
    conf("spark.sql.maxMetadataStringLength", "10000")
    return lambda name: plan_text(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(plan, name):
    text = plan(name)
    for node in ("CartesianProduct", "NestedLoop", "Python", "SinglePartition"):
        assert node not in text


@pytest.mark.parametrize("name", LAZY)
def test_only_checked_rule_tables_are_broadcast(plan, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert plan(name).count("BroadcastExchange") == RULE_TABLES.get(name, 0)


@pytest.mark.parametrize(
    "name, column, stored",
    [
        ("mart_year_totals", "l_shipdate", "l_quantity:double,l_shipdate:timestamp_ntz"),
        ("mart_category_totals", "l_shipdate", "l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz"),
    ],
)
def test_scans_are_narrow_and_filtered(plan, name, column, stored):
    text = plan(name)
    assert f"ReadSchema: struct<{stored}>" in text
    assert f"GreaterThanOrEqual({column},1996-01-01T00:00)" in text
    assert f"LessThan({column},2000-01-01T00:00)" in text


def test_lines_are_scanned_once(plan):
    for name in ("mart_region_totals", "region_totals_enriched", "top_category_per_region"):
        assert len(re.findall(r"lineitem\.parquet", plan(name))) == 1


def test_row_wise_queries_do_not_shuffle(plan):
    for name in ("repair_values", "repair_pairs", "title_case_documents", "typed_columns"):
        assert "Exchange" not in plan(name).replace("BroadcastExchange", "")


@pytest.mark.parametrize(
    "name", ["population_by_region", "region_totals_enriched", "mart_region_totals"]
)
def test_the_years_reach_the_scan_of_the_orders(plan, name):
    text = plan(name)
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in text
    assert "LessThan(o_orderdate,2000-01-01T00:00)" in text


def test_lines_meet_their_sums_before_the_join(plan, conf):
    """The partitioning of the sum per key serves the join: one exchange per join side, one
    for the final sum."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan("mart_category_totals")
    assert text.count("Exchange hashpartitioning(l_partkey") == 1
    assert text.count("Exchange") == 3


def test_lines_do_not_carry_the_texts_of_their_parts_to_their_orders(spark, conf):
    from martwright.workload import star

    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan_text(star.full_sales(spark, SF_DIR))
    # The plan is printed from the last step to the first.
    assert text.index("Exchange hashpartitioning(l_partkey") < text.index("Exchange hashpartitioning(l_orderkey")
    assert text.count("Exchange hashpartitioning(l_") == 2
