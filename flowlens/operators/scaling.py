"""Feature scaling.

Statistics are one aggregate (a one-row DataFrame); applying them is a broadcast join of that
row, so fitting on train and applying to test never collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.aggregates import moments


def fit_standardizer(df: DataFrame, cols: Sequence[str], zero_std_to_one: bool = True) -> DataFrame:
    """Mean and population std per column (numpy ``std``; D8), std 0 → 1."""
    return moments(df, cols, zero_std_to_one)


def apply_standardizer(df: DataFrame, params: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / std for ``cols``; ``params`` is the one-row output of ``fit_standardizer``."""
    j = df.join(F.broadcast(params), how="cross")  # params has exactly one row
    out = j
    for c in cols:
        out = out.withColumn(c, (F.col(c) - F.col(f"mean_{c}")) / F.col(f"std_{c}"))
    return out.drop(*[f"mean_{c}" for c in cols], *[f"std_{c}" for c in cols])


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, zero_std_to_one: bool = True) -> DataFrame:
    """Standardise ``cols`` with statistics of ``fit_on`` (default: ``df``)."""
    return apply_standardizer(df, fit_standardizer(fit_on if fit_on is not None else df, cols, zero_std_to_one), cols)


def with_intercept(df: DataFrame, name: str = "intercept") -> DataFrame:
    """Constant 1.0 feature placed first."""
    return df.select(F.lit(1.0).alias(name), *df.columns)
