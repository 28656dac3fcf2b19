"""The skew-safe lag path equals the plain window."""

import numpy as np

from pyspark.sql import functions as F

from flowlens.operators.windows import lag_growth, next_in_chain


def test_skew_safe_lag_equals_window(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(4000):
        g = ("hot", 1) if i < 2500 else (f"g{rng.integers(0, 40)}", int(rng.integers(0, 2)))
        rows.append((g[0], g[1], int(rng.integers(0, 50000)), i, float(rng.integers(0, 5))))
    df = spark.createDataFrame(rows, "g string, h int, d int, inv int, v double")
    a = {r.inv: (r.prev_value, r.growth) for r in lag_growth(df, ["g", "h"], ["d", "inv"], "v").collect()}
    b = {r.inv: (r.prev_value, r.growth)
         for r in lag_growth(df, ["g", "h"], ["d", "inv"], "v", segment=F.floor(F.col("d") / 700)).collect()}
    assert a == b


def test_segments_with_nulls_and_gaps(spark):
    """NULL groups, orders and values, groups of one row, empty segments between, ties broken by the last key."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        g = None if i % 5 == 0 else f"g{rng.integers(0, 4)}"
        d = None if i % 11 == 0 else int(rng.choice([1, 2, 3, 90, 91, 400, 5000]))
        rows.append((g, d, i, None if i % 7 == 0 else float(rng.integers(0, 4))))
    rows += [("single", 5, 9999, 1.0)]
    df = spark.createDataFrame(rows, "g string, d int, inv int, v double").repartition(7)
    want = {r.inv: (r.prev_value, r.growth) for r in lag_growth(df, ["g"], ["d", "inv"], "v").collect()}
    got = {r.inv: (r.prev_value, r.growth) for r in lag_growth(df, ["g"], ["d", "inv"], "v", segment=F.floor(F.col("d") / 30)).collect()}
    assert got == want and len(got) == 601
    none = lag_growth(df.limit(0), ["g"], ["d", "inv"], "v", segment=F.col("d"))
    assert none.count() == 0 and none.columns == [*df.columns, "prev_value", "growth"]


def test_next_in_chain(spark):
    df = spark.createDataFrame([(2024, 1), (2023, 12), (2024, 2)], "year int, month int")
    got = sorted(tuple(r) for r in next_in_chain(df, ["year", "month"], ["month"]).collect())
    assert got == [(2023, 12, 1), (2024, 1, 2), (2024, 2, None)]
