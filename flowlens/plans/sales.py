"""Retail-sales analyses (SL1-SL8, H3-H5, J1, W1-W4).

Input: a sales DataFrame with the columns of ``adapters.SALES_COLUMNS``. Each function returns
one lazy DataFrame; each result is a single Spark action, where the reference ran a job per
county and per store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.columns import clip01, money, money_sum, r6, relative_width, safe_div
from flowlens.session import cut_lineage
from flowlens.operators.aggregates import arg_max_of_sum, kpi_row
from flowlens.operators.topk import first_k_distinct, top_k_per_group
from flowlens.operators.windows import lag_growth, next_in_chain, period_growth

__all__ = [
    "kpi_row", "totals_by", "top_totals", "performance_summary", "monthly_totals", "with_monthly_total", "year_month_series",
    "top_by_sales", "with_margin_and_growth", "enhanced_county_view", "geo_hierarchy",
    "timeline_chain", "monthly_growth", "max_monthly_total", "first_store_name", "date_range",
]


def totals_by(sales: DataFrame, key: str) -> DataFrame:
    """(key, total): exact sales by key, as ``adapters.sales_totals`` gives them without the joined rows."""
    return sales.groupBy(key).agg(F.sum(money("sale_dollars")).alias("total"))


def top_totals(totals: DataFrame, key: str, k: int = 10) -> DataFrame:
    """SL6/O3: the k keys with the largest totals (ties: key asc), as (key, sales)."""
    sales = totals.select(key, F.col("total").cast("double").alias("sales"))
    return sales.orderBy(F.desc("sales"), F.asc_nulls_last(key)).limit(k)


def performance_summary(by_county: DataFrame, by_item: DataFrame) -> DataFrame:
    """SL1: total sales, top product and top county in one row, from totals by county and by item.

    Each part is a global aggregate or a top-1 (exactly one row), so attaching them to each
    other is a join of one-row relations, not a data-sized cross product.
    """
    by_county = cut_lineage(by_county)  # one row a county, read twice
    total = by_county.agg(F.sum("total").cast("double").alias("total_sales"))
    county = by_county.orderBy(F.desc("total"), F.asc_nulls_last("county")).limit(1).select(F.col("county").alias("top_county"))
    item = top_totals(by_item, "item_description", 1).select(F.col("item_description").alias("top_product"))
    return total.join(F.broadcast(item), how="cross").join(F.broadcast(county), how="cross")


def monthly_totals(sales: DataFrame) -> DataFrame:
    """SL2: calendar-month totals over all years, ordered by month."""
    return (
        sales.groupBy(F.month("date").alias("month"))
        .agg(money_sum("sale_dollars").alias("monthly_total_sales"))
        .orderBy("month")
    )


def max_monthly_total(sales_with_total: DataFrame) -> DataFrame:
    """``groupby('month')['monthly_total_sales'].max()``."""
    return sales_with_total.groupBy("month").agg(F.max("monthly_total_sales").alias("max_monthly_total"))


def with_monthly_total(sales: DataFrame) -> DataFrame:
    """SL3/J1: every sale with its calendar month's total attached.

    The monthly aggregate has at most 12 rows (calendar months), so broadcasting it is safe at
    any input size; the detail side is never shuffled.
    """
    detail = sales.withColumn("month", F.month("date"))
    monthly = detail.groupBy("month").agg(money_sum("sale_dollars").alias("monthly_total_sales"))
    return detail.join(F.broadcast(monthly), "month", "left")


def year_month_series(sales: DataFrame) -> DataFrame:
    """SL5/A6: totals per (year, month) in time order."""
    return (
        sales.groupBy(F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(money_sum("sale_dollars").alias("sales"))
        .orderBy("year", "month")
    )


def timeline_chain(sales: DataFrame) -> DataFrame:
    """Year-month nodes, each with the next period (the dashed edge). One row per period."""
    return next_in_chain(year_month_series(sales), ["year", "month"], ["year", "month"])


def top_by_sales(sales: DataFrame, key: str, k: int = 10) -> DataFrame:
    """SL6/O3: the k keys with the largest sales (ties: key asc)."""
    return arg_max_of_sum(sales, key, "sale_dollars", k).withColumnRenamed("total", "sales")


def with_margin_and_growth(sales: DataFrame) -> DataFrame:
    """SL7: profit margin per row and row-over-row growth within (county, store, item).

    The order ends with the invoice so that the previous row is unique (the reference orders
    by date only). NULL growth on the first row and where the previous sale is 0. Windows run inside a
    group's months (``windows.lag_growth``), so a group of any size is spread.
    """
    m = sales.withColumn(
        "profit_margin",
        safe_div(F.col("state_bottle_retail") - F.col("state_bottle_cost"), F.col("state_bottle_retail")),
    )
    return lag_growth(
        m, ["county", "store_number", "item_description"], ["date", "invoice_and_item_number"],
        "sale_dollars", "prev_month_sales", "sales_growth", segment=F.trunc("date", "month"),
    )


def monthly_growth(sales: DataFrame, entity: str = "county") -> DataFrame:
    """True month-over-month growth per entity (aggregate first, then lag)."""
    return period_growth(sales, [entity], "date", "sales", money_sum("sale_dollars"))


def _all_same(columns: list[str]):
    """NULL-safe equality of each column with its copy named ``_<column>``."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return out


def _only(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose columns are among the keys (a few, so broadcast), NULL equal to NULL."""
    few = F.broadcast(keys.select(*[F.col(c).alias(f"_{c}") for c in columns]))
    return rows.join(few, _all_same(columns), "left_semi")


def enhanced_county_view(sales: DataFrame, n_counties: int = 10, n_stores: int = 3, n_products: int = 2) -> DataFrame:
    """SL8/H4: top counties → top stores per county → top products per (county, store).

    Top-k in phases instead of 1 + 10 + 30 jobs, each level reading only its parents' rows:

    1. totals by county, without growth, choose the counties;
    2. only their rows go through the growth window (groups lie inside a county, so they stay whole) and into
       one aggregate by store, from which county and store figures are derived exactly: money sums are
       decimals, averages are carried as (sum, count). It has one row a store, and is checkpointed;
    3. only the chosen stores' rows (n_counties × n_stores) are aggregated by product, without growth.

    Products are keyed by the full path (county, store); the reference filtered by store only (DF4). One row
    per product leaf with every level's metrics, relative widths (P15), margin colour input (P14) and font
    class. A NULL county is a county: it may hold one of the places.
    """
    place = [F.desc("county_sales"), F.asc_nulls_last("county")]
    totals = sales.groupBy("county").agg(F.sum(money("sale_dollars")).cast("double").alias("county_sales"))
    chosen = cut_lineage(totals.orderBy(*place).limit(n_counties))
    path = ["county", "store_number", "store_name"]
    base = with_margin_and_growth(_only(sales, chosen, ["county"]))
    by_store = cut_lineage(
        base.groupBy(*path).agg(
            F.sum(money("sale_dollars")).alias("_sales"), F.sum("sales_growth").alias("_gsum"), F.count("sales_growth").alias("_gcnt")
        )
    )
    counties = by_store.groupBy("county").agg(
        F.sum("_sales").cast("double").alias("county_sales"), safe_div(F.sum("_gsum"), F.sum("_gcnt")).alias("county_growth")
    )
    # ≤ n_counties rows: a proven broadcast bound
    counties = counties.withColumn("max_county_sales", F.max("county_sales").over(Window.partitionBy()))
    top_c = F.broadcast(counties)

    stores = by_store.select(
        *path, F.col("_sales").cast("double").alias("store_sales"), safe_div(F.col("_gsum"), F.col("_gcnt")).alias("store_growth")
    )
    stores = top_k_per_group(stores, ["county"], [F.desc("store_sales"), F.asc("store_number"), F.asc("store_name")], n_stores, "store_rank")
    stores = stores.withColumn("max_store_sales", F.max("store_sales").over(Window.partitionBy("county")))
    # ≤ n_counties × n_stores rows
    top_s = F.broadcast(stores)

    margin = safe_div(F.col("state_bottle_retail") - F.col("state_bottle_cost"), F.col("state_bottle_retail"))
    products = (
        _only(sales, stores, path)
        .withColumn("_margin", margin)
        .groupBy(*path, "item_description")
        .agg(F.sum(money("sale_dollars")).cast("double").alias("product_sales"), safe_div(F.sum("_margin"), F.count("_margin")).alias("avg_margin"))
    )
    products = top_k_per_group(products, ["county", "store_number", "store_name"], [F.desc("product_sales"), F.asc("item_description")], n_products, "product_rank")
    products = products.withColumn(
        "max_product_sales", F.max("product_sales").over(Window.partitionBy("county", "store_number", "store_name"))
    )

    tree = products.join(top_s.withColumnsRenamed({c: f"_{c}" for c in path}), _all_same(path)).drop(*[f"_{c}" for c in path])
    tree = tree.join(top_c.withColumnRenamed("county", "_county"), _all_same(["county"])).drop("_county")
    return tree.select(
        "county", "store_number", "store_name", "store_rank", "item_description", "product_rank",
        "county_sales", r6("county_growth").alias("county_growth"),
        r6(relative_width("county_sales", "max_county_sales", 1.0, 1.5)).alias("county_width"),
        "store_sales", r6("store_growth").alias("store_growth"),
        r6(relative_width("store_sales", "max_store_sales", 0.5, 1.0)).alias("store_width"),
        "product_sales", r6("avg_margin").alias("avg_margin"),
        r6(relative_width("product_sales", "max_product_sales", 0.3, 0.7)).alias("product_width"),
        r6(clip01("avg_margin")).alias("margin_norm"),
        F.when(F.col("avg_margin") > 0.2, "black").otherwise("white").alias("font_color"),
    )


def first_store_name(sales: DataFrame) -> DataFrame:
    """First name of each store by (date, invoice) — deterministic ``iloc[0]``."""
    return sales.groupBy("store_number").agg(
        F.min_by("store_name", F.struct("date", "invoice_and_item_number")).alias("store_name")
    )


def _level(df: DataFrame) -> DataFrame:
    """df written down, its columns new, so that it can be joined with the rows that it came from."""
    done = cut_lineage(df)
    return done.select(*[F.col(c).alias(c) for c in done.columns])


def geo_hierarchy(sales: DataFrame, n_counties: int = 5, n_stores: int = 3, by_county: DataFrame | None = None) -> DataFrame:
    """H3: top counties → first stores (smallest numbers, O6) → store name and top product.

    As in the reference, a store's name and top product come from all of the store's sales. The fact is read once a level: totals by county
    (or ``by_county``), the chosen counties' stores, and one aggregate by (store, item) of the chosen stores, which carries
    the first name as well. Each level (n_counties rows, n_counties × n_stores rows, the items of these stores) is written down.
    """
    totals = by_county if by_county is not None else totals_by(sales, "county")
    named = totals.filter(F.col("county").isNotNull())  # a group without a name is no county (D1)
    counties = _level(top_totals(named, "county", n_counties).withColumnRenamed("sales", "county_sales"))
    stores = first_k_distinct(_only(sales, counties, ["county"]), ["county"], "store_number", n_stores)
    stores = _level(stores.withColumnRenamed("rank", "store_rank"))
    first = F.min(F.struct("date", "invoice_and_item_number", "store_name")).alias("_first")
    by_item = _level(
        _only(sales, stores.select("store_number").distinct(), ["store_number"])
        .groupBy("store_number", "item_description").agg(money_sum("sale_dollars").alias("product_sales"), first)
    )
    names = by_item.groupBy("store_number").agg(F.min("_first")["store_name"].alias("store_name"))
    top = top_k_per_group(by_item, ["store_number"], [F.desc("product_sales"), F.asc("item_description")], 1, "_r").drop("_r", "_first")
    return (
        stores.join(F.broadcast(counties), "county")
        .join(names, "store_number", "left")
        .join(top, "store_number", "left")
        .select("county", "county_sales", "store_rank", "store_number", "store_name",
                F.col("item_description").alias("top_product"), "product_sales")
    )


def date_range(sales: DataFrame) -> DataFrame:
    """A20."""
    return sales.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))
