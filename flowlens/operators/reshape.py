"""Set operations and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def node_set(edges: DataFrame, a: str = "node1", b: str = "node2", name: str = "node") -> DataFrame:
    """Distinct union of two columns."""
    return edges.select(F.col(a).alias(name)).union(edges.select(F.col(b).alias(name))).distinct()


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var_name: str, value_name: str, dropna: bool = True) -> DataFrame:
    """Wide → long (``melt(...).dropna()``)."""
    long = df.unpivot(list(ids), list(values), var_name, value_name)
    return long.filter(F.col(value_name).isNotNull()) if dropna else long


def pivot_count(df: DataFrame, row: str, col: str, values: Sequence[str] | None = None) -> DataFrame:
    """R2: two-key counts as a wide table with 0 for missing cells.

    Passing the pivot ``values`` avoids the extra job Spark runs to discover them.
    """
    g = df.groupBy(row)
    p = g.pivot(col, list(values)) if values is not None else g.pivot(col)
    return p.count().na.fill(0)
