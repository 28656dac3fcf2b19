"""The streaming aggregates agree with their batch forms."""

from flowlens.plans import sales as S
from flowlens.sources import adapters as A
from flowlens.streaming.incremental import county_totals_stream, monthly_totals_stream, run_to_table
from tests.conftest import SF_SMALL


def test_monthly_totals_stream_equals_batch(spark):
    got = sorted(tuple(r) for r in run_to_table(monthly_totals_stream(spark, SF_SMALL)).collect())
    want = sorted(tuple(r) for r in S.monthly_totals(A.sales_view(spark, SF_SMALL, ["date", "sale_dollars"])).collect())
    assert got == want


def test_county_totals_stream_equals_batch(spark):
    got = sorted(tuple(r) for r in run_to_table(county_totals_stream(spark, SF_SMALL)).collect())
    sales = A.sales_view(spark, SF_SMALL, ["county", "sale_dollars"])
    want = sorted(tuple(r) for r in S.top_by_sales(sales, "county", 1000).collect())
    assert got == want
