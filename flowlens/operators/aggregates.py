"""Aggregations.

All of these compile to HashAggregate partial → shuffle → final, so only one row per group
per task crosses the network. Tie and NULL rules follow SURVEY §1.3 (D1-D5).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import col_, money, money_sum, r6, safe_div


def frequency(df: DataFrame, key: str, drop_null: bool = True, name: str = "count") -> DataFrame:
    """A10 ``value_counts``: (key, count); pandas drops NULL keys."""
    src = df.filter(F.col(key).isNotNull()) if drop_null else df
    return src.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def conditional_rate(df: DataFrame, keys: Sequence[str], cond: Column, name: str, scale: float = 100.0) -> DataFrame:
    """Share of rows meeting ``cond`` per group (rows as base), in percent."""
    return df.groupBy(*keys).agg((F.avg(F.when(cond, 1.0).otherwise(0.0)) * scale).alias(name))


def arg_max_of_sum(df: DataFrame, key: str, value: str | Column, k: int = 1, money_value: bool = True) -> DataFrame:
    """The k keys with the largest sum; ties broken by key asc.

    Plans as partial aggregate → shuffle → TakeOrderedAndProject: no global sort.
    """
    total = money_sum(value) if money_value else F.sum(col_(value))
    return df.groupBy(key).agg(total.alias("total")).orderBy(F.desc("total"), F.asc_nulls_last(key)).limit(k)


def mean_of_group_distinct(df: DataFrame, group: str, col: str, name: str) -> DataFrame:
    """Mean over groups of the number of distinct values per group."""
    per = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(col).alias("_n"))
    return per.agg(F.avg("_n").alias(name))


def mean_gap_days(d: Column) -> Column:
    """A17 as an aggregate: mean gap between successive dates, whole days, 0 with fewer than 2 dates.

    The mean of successive differences telescopes to (max - min) / (n - 1), so no sort or
    per-group list is needed; ``.days`` of a timedelta is a floor.
    """
    gap = F.floor(F.datediff(F.max(d), F.min(d)) / (F.count(d) - F.lit(1)))
    return F.when(F.count(d) >= 2, gap).otherwise(F.lit(0)).cast("bigint")


def moments(df: DataFrame, cols: Iterable[str], zero_std_to_one: bool = True) -> DataFrame:
    """One row with ``mean_<c>`` and population ``std_<c>`` for every column."""
    aggs = []
    for c in cols:
        aggs.append(F.avg(c).alias(f"mean_{c}"))
        sd = F.stddev_pop(c)
        if zero_std_to_one:
            sd = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        aggs.append(sd.alias(f"std_{c}"))
    return df.agg(*aggs)


def ordered_text(df: DataFrame, keys: Sequence[str], text: Column, order: Sequence[Column], sep: str = "\n", name: str = "text") -> DataFrame:
    """One text per group, lines ordered by ``order`` (listagg WITHIN GROUP).

    Collects each group's lines into one list, so it is meant for bounded groups (the first k
    reasons of a column), not for raw rows.
    """
    ordered = F.sort_array(F.collect_list(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], text.alias("_t"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda s: s["_t"]), sep).alias(name))


def sums_and_distinct(df: DataFrame, sums: dict[str, Column], distinct: dict[str, Column]) -> DataFrame:
    """One row: plain aggregates, and exact counts of distinct whole numbers, all in one pass over ``df``.

    A number sets one bit of a bitmap of 32,768 (its bucket's); bitmaps are built map-side and merged by (count, bucket),
    so no task holds a set of values, and a shuffle row stands for up to 32,768 of them. Each row is expanded
    once for each count inside the task; the first copy carries the summands. ``sums`` are named columns to be
    added up (NULLs are skipped). NULL numbers are not counted.
    """
    names = list(distinct)
    copies = F.array(*[F.struct(F.lit(i).alias("which"), c.cast("bigint").alias("number")) for i, c in enumerate(distinct.values())])
    rows = df.select(*[c.alias(f"_s{i}") for i, c in enumerate(sums.values())], F.explode(copies).alias("_c"))
    first = F.col("_c.which") == 0
    bits = (
        rows.groupBy(F.col("_c.which").alias("which"), F.bitmap_bucket_number("_c.number").alias("bucket"))
        .agg(
            F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_c.number"))).alias("n"),
            *[F.sum(F.when(first, F.col(f"_s{i}"))).alias(f"_s{i}") for i in range(len(sums))],
        )
    )
    counts = [F.coalesce(F.sum(F.when((F.col("which") == i) & F.col("bucket").isNotNull(), F.col("n"))), F.lit(0)).alias(n) for i, n in enumerate(names)]
    return bits.agg(*[F.sum(f"_s{i}").alias(n) for i, n in enumerate(sums)], *counts)


def kpi_row(sales: DataFrame) -> DataFrame:
    """A8/SL4: six sales KPIs in one pass; an invoice is numbered by its order and line (``invoice_number``)."""
    both = F.col("state_bottle_retail") - F.col("state_bottle_cost")
    row = sums_and_distinct(
        sales,
        {"sales": money("sale_dollars"), "bottles": F.col("bottles_sold"), "liters": F.col("volume_sold_liters"), "profit": both,
         "with_profit": F.when(both.isNotNull(), 1).otherwise(0)},
        {"invoices": F.col("invoice_number"), "stores": F.col("store_number")},
    )
    total = F.col("sales").cast("double")
    return row.select(
        total.alias("total_sales"), F.col("bottles").cast("bigint").alias("total_bottles"), r6("liters").alias("total_liters"),
        r6(safe_div("profit", "with_profit")).alias("profit_per_bottle"),
        r6(safe_div(total, F.col("invoices"))).alias("aov"), r6(safe_div("invoices", "stores")).alias("aof"),
    )
