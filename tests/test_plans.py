"""Plans: what reaches the scan, which joins appear, what stays out."""

import re

import pytest

from spindrift.plans import retail
from spindrift.plans.report import operators_of, plan_report, plan_text
from spindrift.queries import load
from tests.conftest import SF

QUERIES, _ = load()


def text(spark, name):
    return plan_text(QUERIES[name](spark, SF))


def test_filters_and_columns_reach_the_scan(spark):
    plan = text(spark, "src01_parquet_scan")
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "struct<l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan


def test_daily_sales_reads_five_columns(spark, tables):
    plan = plan_text(retail.daily_sales(tables))
    assert "l_comment" not in plan and "o_orderstatus" not in plan and "l_tax" not in plan


@pytest.mark.parametrize("name", ["jn01_inner", "jn09_self_range_join", "jn10_shared_attribute", "jn11_interval_join", "jn16_hot_key_join",
                                  "o05_impossible_travel", "o08_composite_risk", "o09_fraud_cases", "m01_merge", "m08_change_feed",
                                  "c16_skew_report", "w07_trailing_month_stats"])
def test_no_products_and_no_python(spark, name):
    used = operators_of(text(spark, name))
    assert used and not {"CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"} & set(used)


def test_top_k_is_limited_before_the_shuffle(spark):
    plan = text(spark, "w10_top_k_per_group")
    assert operators_of(plan).count("WindowGroupLimit") == 2


def test_bucketed_join_has_no_exchange_below(spark):
    names = operators_of(text(spark, "src19_bucketed_join"))
    assert "SortMergeJoin" in names and names.count("Exchange") == 1


def test_latest_rows_combine_before_the_shuffle(spark):
    names = operators_of(text(spark, "a15_latest_per_key"))
    assert "Window" not in names and sum(n.endswith("Aggregate") for n in names) == 2


def test_report(spark, tables):
    items = {r["item"] for r in plan_report(retail.daily_sales(tables)).collect()}
    assert {"join", "exchange", "read_schema"} <= items


def test_sketch_beside_a_distinct_count_is_kept_by_group_alone(spark):
    """In one aggregate Spark carries the sketch for every pair of flag and order."""
    plan = text(spark, "a04_sketch_error")
    found = re.findall(r"Keys \[\d+\]: (.*)\nFunctions \[\d+\]: (.*)", plan)
    sketched = [keys for keys, functions in found if "approx_count_distinct" in functions]
    assert sketched and not any("l_orderkey" in keys for keys in sketched)
