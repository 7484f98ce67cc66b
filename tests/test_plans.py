"""Properties of the physical plans."""

import re

import pytest

from feira import registry
from feira.operators import drilldown, rfm
from feira.registry import RFM_INPUT, World


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# queries that write and read tables or files, or run dozens of plans
LARGE = {
    "src_csv_entities", "sink_mart", "sink_raw_load", "sink_report", "marts_monthly_sales_trend", "report_contract",
    "marts_order_vs_aov", "marts_holiday_impact_all_orders", "marts_category_sales", "marts_holiday_window_demand",
    "dq_not_null", "dq_unique", "dq_relationships", "profile_columns_merged", "src_layer_frames", "dq_suite_run_raw",
    "dq_failure_detail_raw",
}
NAMES = sorted(set(registry.queries()) - LARGE)


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loops_or_cross_joins(spark, folder, name):
    text = plan(registry.queries()[name](spark, folder))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|MapInPandas)", text)


def test_scores_need_no_global_sort(spark, folder):
    w = World(spark, folder)
    text = plan(rfm.fct_customer_rfm(w.rfm_input, w.cat.settings.analysis_date))
    assert "SinglePartition" not in text and "Window" not in text


def test_window_reaches_the_scan_columns(spark, folder):
    """Reports read only the columns they use."""
    text = plan(registry.queries()["order_vs_aov"](spark, folder))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert all("l_quantity" not in s and "o_totalprice" not in s for s in schemas)


@pytest.mark.parametrize("name", [
    "marts_monthly_sales_trend", "marts_order_vs_aov", "marts_holiday_impact_all_orders", "marts_category_sales",
])
def test_windows_open_month_folders_of_both_facts(spark, folder, name):
    text = plan(registry.queries()[name](spark, folder)).split("Initial Plan")[-1]
    facts = [line for line in text.splitlines() if "FileScan" in line and "order_key#" in line]
    assert len(facts) == 2
    assert all("month_key" in re.search(r"PartitionFilters: \[([^\]]*)", line)[1] for line in facts)


def test_holiday_windows_open_their_month_folders(spark, folder):
    text = plan(registry.queries()["marts_holiday_window_demand"](spark, folder))
    # the sums are pinned, so the plan of the summing itself is looked at
    w = registry.World(spark, folder)
    tables = registry._published(w, "dim_product", "fact_order_items")
    seen = []
    kept = drilldown.pinned
    drilldown.pinned = lambda df: (seen.append(plan(df)), kept(df))[1]
    try:
        drilldown.holiday_window_demand(w.cat.stg_holiday_calendar, tables.fact_order_items(), tables.dim_product)
    finally:
        drilldown.pinned = kept
    assert text and any(re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", t) for t in seen)


def test_segment_figures_leave_out_the_customer_dimension(spark, folder):
    w = World(spark, folder)
    assert "first_order" not in plan(w.rfm_scores) and "customer_unique_id" not in plan(w.rfm_scores)


def test_narrow_facts_skip_lookups(spark, folder):
    w = World(spark, folder)
    assert "supplier.parquet" not in plan(w.money) and "part.parquet" not in plan(w.money)
    assert "lineitem" in plan(w.cat.fact_orders(RFM_INPUT))
    assert "lineitem" not in plan(w.spine)


@pytest.mark.parametrize("name", [
    "monthly_sales_trend", "monthly_state_sales", "region_rollup", "rfm_analysis", "rfm_detail", "top_customers",
    "report_top10_view", "pivot_month_region",
])
def test_locations_are_left_out_where_nobody_reads_them(spark, folder, name):
    text = plan(registry.queries()[name](spark, folder))
    assert "geolocation" not in text
    if name in ("rfm_detail", "top_customers"):  # names alone need no orders either
        assert "customer_city" not in text and "max(struct(order_purchase_timestamp" not in text


def test_only_counted_frames_are_broadcast(spark):
    from feira.plans.sizing import checked_broadcast

    small, big = spark.range(10), spark.range(11)
    facts = spark.range(100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(facts.join(checked_broadcast(small, 10), "id"))
        assert "BroadcastHashJoin" not in plan(facts.join(checked_broadcast(big, 10), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
