"""Window operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.columns import safe_div


def lag_growth(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
               prev_name: str = "prev_value", growth_name: str = "growth", segment: Column | None = None) -> DataFrame:
    """Previous row's value in the group and (x - prev) / prev (NULL on the first row or prev = 0).

    ``order`` (column names) must end with a unique key so the previous row is well defined.

    ``segment`` is a coarser step along the order that never goes back in a group (such as the month of the date
    it begins with; NULLs first). With it, one group may be of any size: the window runs inside (group, segment), and
    only a segment's first row looks further, to the last row of the group's nearest earlier segment that has one.
    Those last rows are a partial aggregate, one for each (group, segment), lagged in a window of their own, so empty
    segments are carried over. There is one path at every size: no detection of large groups and no broadcast. Keys
    are compared as structs, where NULL equals NULL.
    """
    if segment is None:
        w = Window.partitionBy(*group).orderBy(*order)
        out = df.withColumn(prev_name, F.lag(value, 1).over(w))
    else:
        key = F.struct(F.struct(*group).alias("of"), segment.alias("at"))
        rows = df.withColumn("_key", key)
        inside = Window.partitionBy("_key").orderBy(*order)
        ends = rows.groupBy("_key").agg(F.max_by(F.struct(value), F.struct(*order)).alias("_end"))
        along = Window.partitionBy("_key.of").orderBy("_key.at")
        carried = ends.select("_key", F.lag("_end", 1).over(along).getField(value).alias("_carried"))
        own = rows.withColumn("_place", F.row_number().over(inside)).withColumn(prev_name, F.lag(value, 1).over(inside))
        prev = F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col(prev_name))
        out = own.join(carried, "_key", "left").withColumn(prev_name, prev).drop("_key", "_place", "_carried")
    return out.withColumn(growth_name, safe_div(F.col(value) - F.col(prev_name), F.col(prev_name)))


def period_growth(df: DataFrame, entity: Sequence[str], date_col: str, value: str, total: Column) -> DataFrame:
    """Aggregate per (entity, year, month), then growth against the entity's previous month.

    The window runs over the aggregate (≤ one row per entity and month), never over raw rows.
    """
    agg = df.groupBy(*entity, F.year(date_col).alias("year"), F.month(date_col).alias("month")).agg(total.alias(value))
    w = Window.partitionBy(*entity).orderBy("year", "month")
    prev = F.lag(value, 1).over(w)
    return agg.withColumn("prev_" + value, prev).withColumn("growth", safe_div(F.col(value) - F.col("prev_" + value), F.col("prev_" + value)))


def next_in_chain(df: DataFrame, order: Sequence[str], cols: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Each row with the next row's ``cols`` (edge to the next period)."""
    w = Window.partitionBy(*group).orderBy(*order) if group else Window.orderBy(*order)
    out = df
    for c in cols:
        out = out.withColumn("next_" + c, F.lead(c, 1).over(w))
    return out
