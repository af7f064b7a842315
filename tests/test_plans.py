"""What the plans must look like at scale, read off the physical plans."""

from __future__ import annotations

import os
import re

import pytest

from __spark_entry__ import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

def plan(spark, name):
    return queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dedup_first", "clean_sales", "clean_events", "bq02_top_products", "forecast_ma"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit.*Partial", plan(spark, name))


@pytest.mark.parametrize("name, columns", [
    ("bq06_customer_cohorts", "l_orderkey:bigint>"), ("dq_ref_integrity", "l_partkey:bigint>"),
    ("vw03_category_trend", "l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_ext")])
def test_scans_read_needed_columns_only(spark, name, columns):
    assert f"ReadSchema: struct<{columns}" in plan(spark, name)


@pytest.mark.parametrize("name", ["bq05_holiday_impact", "star_join", "weekly_demand_wow", "holiday_enrich"])
def test_small_dimensions_never_shuffle_the_sales(spark, name):
    text = plan(spark, name)
    for key in ("store_id", "product_id", "sale_date", "transaction_id"):
        assert not re.search(rf"hashpartitioning\({key}#\d+L?, \d+\), ENSURE_REQUIREMENTS", text)


@pytest.mark.parametrize("name", ["bq07_abc_classes", "vw01_monthly_product_rank", "dim_product_upsert"])
def test_large_orders_are_not_sorted_in_one_task(spark, name):
    """The only window without a partition runs over one row per slice."""
    for line in plan(spark, name).splitlines():
        if "Window [" in line and "_slice" not in line and line.rstrip().endswith("[]"):
            pytest.fail(line)


@pytest.mark.parametrize("name, filters", [("insert_ignore", "IsNotNull(o_orderkey)"), ("bq06_customer_cohorts", "IsNotNull(o_custkey)")])
def test_filters_reach_the_scan(spark, name, filters):
    assert filters in plan(spark, name)


def test_sales_joins_survive_without_broadcast(spark):
    """Beyond the threshold the same queries run as shuffled joins."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, "vw03_category_trend")
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
