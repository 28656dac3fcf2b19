"""Sort, limit and top-k operators.

Per-group top-k uses ``row_number`` + a filter on the rank, which Spark plans as a
WindowGroupLimit: each task keeps at most k rows per group before the shuffle, so a group
holding a large share of the rows costs one k-row heap, not one huge sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """The first k rows of every group by ``order`` (which must end with a unique key)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def first_k_distinct(df: DataFrame, group: Sequence[str], key: str, k: int) -> DataFrame:
    """K distinct keys per group; the reference's arbitrary pick is re-aimed as the smallest k."""
    return top_k_per_group(df.select(*group, key).distinct(), group, [F.asc(key)], k)


def sort_by_abs(df: DataFrame, value: str, name_col: str) -> DataFrame:
    """Order by |value| desc, then name (coefficient tables)."""
    return df.withColumn("abs_value", F.abs(value)).orderBy(F.desc("abs_value"), F.asc(name_col))
