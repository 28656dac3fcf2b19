"""Sales operators on a hand-made fixture with the edge rows of FIXTURES.md: equal store totals,
retail 0 (margin NULL), previous sale 0 (growth NULL), a store in two counties, one store number
with two names, two sales on the same day."""

import datetime

from flowlens.plans import sales as S

D = datetime.date
COLS = ("invoice_and_item_number string, date date, store_number bigint, store_name string, county string, "
        "item_description string, sale_dollars double, bottles_sold bigint, volume_sold_liters double, "
        "state_bottle_retail double, state_bottle_cost double")


def sales(spark):
    rows = [
        ("i1", D(2022, 1, 1), 1, "Store One", "POLK", "VODKA", 0.0, 1, 1.0, 10.0, 8.0),
        ("i2", D(2022, 1, 2), 1, "Store One", "POLK", "VODKA", 50.0, 2, 2.0, 10.0, 8.0),   # previous sale 0 → growth NULL
        ("i3", D(2022, 1, 2), 1, "Store One", "POLK", "VODKA", 100.0, 3, 3.0, 10.0, 8.0),  # same day, ordered by invoice
        ("i4", D(2022, 2, 1), 2, "Store Two", "POLK", "GIN", 150.0, 1, 1.0, 0.0, 0.0),     # retail 0 → margin NULL
        ("i5", D(2022, 2, 3), 3, "Store Three", "POLK", "RUM", 150.0, 1, 1.0, 20.0, 10.0), # equal store totals 2 vs 3
        ("i6", D(2022, 3, 1), 1, "Store 1 (renamed)", "LINN", "VODKA", 40.0, 1, 1.0, 10.0, 9.0),  # store in two counties, 2 names
    ]
    return spark.createDataFrame(rows, COLS)


def test_margin_and_growth_nulls(spark):
    g = {r.invoice_and_item_number: r for r in S.with_margin_and_growth(sales(spark)).collect()}
    assert g["i1"].prev_month_sales is None and g["i1"].sales_growth is None
    assert g["i2"].prev_month_sales == 0.0 and g["i2"].sales_growth is None  # division by a 0 previous sale
    assert g["i3"].prev_month_sales == 50.0 and g["i3"].sales_growth == 1.0
    assert g["i4"].profit_margin is None  # retail 0
    assert g["i5"].profit_margin == 0.5


def test_top_and_ties(spark):
    s = sales(spark)
    top = S.top_by_sales(s, "county", 1).first()
    assert (top.county, top.sales) == ("POLK", 450.0)
    summary = S.performance_summary(S.totals_by(s, "county"), S.totals_by(s, "item_description")).first()
    assert summary.total_sales == 490.0 and summary.top_county == "POLK"
    assert summary.top_product == "VODKA"  # 0 + 50 + 100 + 40
    top2 = [(r.item_description, r.sales) for r in S.top_by_sales(s, "item_description", 2).collect()]
    assert sorted(top2) == [("GIN", 150.0), ("VODKA", 190.0)]  # GIN and RUM tie at 150: name order decides


def test_drilldown_keys_by_full_path_and_breaks_ties(spark):
    rows = S.enhanced_county_view(sales(spark), n_counties=2, n_stores=3, n_products=2).collect()
    polk = sorted((r.store_rank, r.store_number) for r in rows if r.county == "POLK")
    # stores 2 and 3 tie at 150: the smaller store number ranks first
    assert polk == [(1, 1), (2, 2), (3, 3)]
    linn = [r for r in rows if r.county == "LINN"]
    # the renamed store is its own (county, store, name) path with only its LINN sales
    assert len(linn) == 1 and linn[0].store_name == "Store 1 (renamed)" and linn[0].product_sales == 40.0


def test_first_name_and_monthly(spark):
    s = sales(spark)
    names = {r.store_number: r.store_name for r in S.first_store_name(s).collect()}
    assert names[1] == "Store One"  # earliest (date, invoice)
    monthly = {r.month: r.monthly_total_sales for r in S.monthly_totals(s).collect()}
    assert monthly == {1: 150.0, 2: 300.0, 3: 40.0}
    detail = S.with_monthly_total(s).collect()
    assert {r.invoice_and_item_number: r.monthly_total_sales for r in detail}["i6"] == 40.0
