"""Physical-plan properties that the 100 TB design relies on (static plans, AQE off)."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def plan_of(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def scan_columns(plan, prefix):
    """Column lists of the Parquet scans whose columns start with ``prefix`` (l_ → lineitem)."""
    out = []
    for cols in re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan):
        names = [c.split("#")[0] for c in cols.split(",")]
        if names and all(n.startswith(prefix) for n in names):
            out.append(names)
    return out


def test_kpi_row_prunes_columns_and_avoids_sort_merge(spark):
    p = plan_of(spark, "sl4_kpi_row")
    scans = scan_columns(p, "l_")
    assert scans and all(len(c) <= 7 for c in scans), scans  # 11-column table, 7 needed
    assert "SortMergeJoin" not in p and "CartesianProduct" not in p


def test_monthly_total_join_is_broadcast(spark):
    p = plan_of(spark, "sl3_detail_with_monthly_total")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_top_k_per_group_uses_window_group_limit(spark):
    p = plan_of(spark, "h3_geo_hierarchy")
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize("name", ["m1_random_split", "m2_stratified_split", "m4_sample_n_per_class"])
def test_split_is_one_scan_without_window_or_shuffle(spark, name):
    p = plan_of(spark, name)
    assert p.count("FileScan") == 1
    assert "Window" not in p and "Exchange" not in p


@pytest.mark.parametrize("name", ["t1_scores", "e1_confusion", "m11_scale_test_with_train"])
def test_scoring_scans_the_fact_twice_at_most(spark, name):
    assert plan_of(spark, name).count("FileScan") <= 2


@pytest.mark.parametrize("name", ["h8_interaction_network", "f14_stage_summary", "sl1_sales_summary"])
def test_no_data_sized_cartesian_product(spark, name):
    p = plan_of(spark, name)
    assert "CartesianProduct" not in p
