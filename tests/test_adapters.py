"""Domain views: left joins keep every fact row; unused dimensions are not joined."""

from flowlens.sources import adapters as A
from flowlens.sources.readers import read_table
from tests.conftest import SF_SMALL


def test_views_keep_all_fact_rows(spark):
    n_li = read_table(spark, SF_SMALL, "lineitem").count()
    assert A.sales_view(spark, SF_SMALL).count() == n_li
    assert A.sales_view(spark, SF_SMALL, ["sale_dollars"]).count() == n_li
    assert A.labelled_view(spark, SF_SMALL).count() == n_li
    n_doc = read_table(spark, SF_SMALL, "documents").count()
    assert A.no_interest_view(spark, SF_SMALL).count() == n_doc
    assert A.managers_view(spark, SF_SMALL).count() == read_table(spark, SF_SMALL, "customer").count()
    ev = read_table(spark, SF_SMALL, "events")
    assert A.interactions_view(spark, SF_SMALL).count() == ev.count()
    assert A.interactions_view(spark, SF_SMALL).filter("lead_stage is null").count() == ev.filter("event_type = 'error'").count()


def test_no_interest_has_one_reason_per_row(spark):
    ni = A.no_interest_view(spark, SF_SMALL)
    per_row = ni.selectExpr(" + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in A.REASON_COLUMNS) + " AS k")
    assert {r.k for r in per_row.distinct().collect()} == {1}


def test_sales_view_joins_only_needed_dimensions(spark):
    plan = A.sales_view(spark, SF_SMALL, ["date", "sale_dollars"])._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in plan and "c_custkey" not in plan and "p_partkey" not in plan and "s_suppkey" not in plan
    plan2 = A.sales_view(spark, SF_SMALL, ["county", "sale_dollars"])._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" in plan2 and "p_partkey" not in plan2
