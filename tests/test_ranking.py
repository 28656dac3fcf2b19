"""W7 primitives against brute force: exact first-n by hash, dense index, prefix sums, samplers."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from flowlens.operators import ranking as RK
from flowlens.operators import sampling as SM


def md5(seed, *parts):
    return hashlib.md5("|".join([str(seed)] + [str(p) for p in parts]).encode()).hexdigest()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(7)
    data = [(int(i), int(rng.random() < 0.2)) for i in range(3000)]
    return spark.createDataFrame(data, "id bigint, label int"), data


@pytest.mark.parametrize("n", [0, 1, 7, 250, 2999, 5000])
@pytest.mark.parametrize("levels", [(1, 1000), (1, 5), (3, 1000)])
def test_first_n_global_matches_sort(spark, labelled, n, levels, monkeypatch):
    df, data = labelled
    h = df.withColumn("_h", RK.hash_key(42, "id"))
    d, mx = levels
    monkeypatch.setattr(RK, "BOUNDARY_ROWS", mx)
    got = sorted(r.id for r in RK.first_n_flag(h, "_h", n, (), "sel", level_digits=d).filter("sel").collect())
    want = sorted(sorted(i for i, _ in data)[:0] if n == 0 else [i for i, _ in sorted(data, key=lambda t: md5(42, t[0]))[:n]])
    assert got == want


@pytest.mark.parametrize("mx", [1000, 3])
def test_first_n_per_group_with_targets(spark, labelled, mx, monkeypatch):
    df, data = labelled
    monkeypatch.setattr(RK, "BOUNDARY_ROWS", mx)
    h = df.withColumn("_h", RK.hash_key(9, "id"))
    targets = spark.createDataFrame([(0, 100), (1, 3)], "label int, n bigint")
    flagged = RK.first_n_flag(h, "_h", targets, ["label"], "sel", level_digits=1)
    got = sorted((r.label, r.id) for r in flagged.filter("sel").collect())
    want = []
    for c, n in [(0, 100), (1, 3)]:
        ids = sorted((i for i, l in data if l == c), key=lambda i: md5(9, i))[:n]
        want += [(c, i) for i in ids]
    assert got == sorted(want)


def test_stratified_split_sizes_and_determinism(spark, labelled):
    df, data = labelled
    s1 = SM.stratified_split(df, "id", "label", 0.2, 42)
    counts = {(r.label, r.is_train): r["count"] for r in s1.groupBy("label", "is_train").count().collect()}
    n0 = sum(1 for _, l in data if l == 0)
    n1 = len(data) - n0
    assert counts[(0, True)] == int(n0 * 0.8) and counts[(1, True)] == int(n1 * 0.8)
    s2 = SM.stratified_split(df.repartition(7), "id", "label", 0.2, 42)
    assert sorted(tuple(r) for r in s1.collect()) == sorted(tuple(r) for r in s2.collect())


def test_null_class_is_split_like_any_other(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 3) for i in range(750)], "id bigint, label int")
    counts = {(r.label, r.is_train): r["count"] for r in SM.stratified_split(df, "id", "label", 0.2, 42).groupBy("label", "is_train").count().collect()}
    assert counts == {(c, t): n for c in (None, 1, 2) for t, n in ((True, 200), (False, 50))}


def test_flag_is_a_projection_of_one_scan(spark):
    from flowlens.sources.adapters import labelled_view
    from tests.conftest import SF_SMALL

    flagged = SM.stratified_split(labelled_view(spark, SF_SMALL), "row_id", "label", 0.2, 42)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Window" not in plan


def test_undersample_ratio_exact(spark, labelled):
    df, data = labelled
    n1 = sum(l for _, l in data)
    out = SM.undersample_ratio(df, "id", "label", 0.5)
    c = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert c == {1: n1, 0: int(n1 / 0.5)}


def test_fraction_sample_is_hash_threshold(spark, labelled):
    df, data = labelled
    got = sorted(r.id for r in SM.sample_fraction(df, "id", 0.1, 3).collect())
    want = sorted(i for i, _ in data if int(md5(3, i)[:13], 16) / 16 ** 13 < 0.1)
    assert got == want


def test_dense_index(spark):
    rng = np.random.default_rng(1)
    keys = rng.choice(10 ** 9, size=2000, replace=False)
    df = spark.createDataFrame([(int(k),) for k in keys], "k bigint")
    got = {r.k: r.idx for r in RK.dense_index(df, "k", "idx", n_buckets=16).collect()}
    assert got == {int(k): i for i, k in enumerate(sorted(keys))}


def test_prefix_sums(spark):
    rng = np.random.default_rng(2)
    xs = rng.random(3000)
    vs = rng.integers(0, 5, 3000)
    df = spark.createDataFrame([(float(x), int(v)) for x, v in zip(xs, vs)], "s double, v bigint")
    got = {r.s: r.cum_v for r in RK.prefix_sums(df, "s", ["v"], exclusive=True, n_buckets=32).collect()}
    order = np.argsort(xs)
    run = 0
    for i in order:
        assert got[float(xs[i])] == run
        run += int(vs[i])


@pytest.mark.parametrize("targets", [(5, 2), (900, 40), (1500, 400)])
def test_first_n_small_and_large_paths(spark, labelled, targets):
    df, data = labelled
    h = df.withColumn("_h", RK.hash_key(5, "id"))
    t = spark.createDataFrame([(0, targets[0]), (1, targets[1])], "label int, n bigint")
    got = sorted((r.label, r.id) for r in RK.first_n(h, "_h", t, ["label"]).collect())
    want = []
    for c, n in [(0, targets[0]), (1, targets[1])]:
        want += [(c, i) for i in sorted((i for i, l in data if l == c), key=lambda i: md5(5, i))[:n]]
    assert got == sorted(want)
    glob = sorted(r.id for r in RK.first_n(h, "_h", targets[0]).collect())
    assert glob == sorted(i for i, _ in sorted(data, key=lambda t: md5(5, t[0]))[:targets[0]])


def test_ranges_follow_the_row_count(spark, monkeypatch):
    """Skewed, negative and NULL-free orders of any type; the number of ranges comes from the rows."""
    monkeypatch.setattr(RK, "ROWS_A_PART", 100)
    rng = np.random.default_rng(4)
    xs = sorted({float(x) for x in np.concatenate([rng.normal(size=700), rng.normal(size=300) * 1e-9])})
    df = spark.createDataFrame([(x, 1, f"k{i:05d}") for i, x in enumerate(xs)], "s double, v bigint, name string").repartition(3)
    got = {r.s: (r.cum_v, r.cum_w) for r in RK.prefix_sums(df.selectExpr("*", "2 * v AS w"), "s", ["v", "w"], exclusive=False).collect()}
    assert got == {x: (i + 1, 2 * i + 2) for i, x in enumerate(xs)}
    parts = RK._in_parts(df, "s", None)
    assert parts.select("_bk").distinct().count() == -(-len(xs) // 100)
    assert {r.name: r.idx for r in RK.dense_index(df, "name").collect()} == {f"k{i:05d}": i for i in range(len(xs))}
    assert RK.prefix_sums(df.limit(0), "s", ["v"]).count() == 0


def test_sums_and_distinct_in_one_pass(spark):
    from flowlens.operators.aggregates import sums_and_distinct

    rng = np.random.default_rng(6)
    rows = [(int(a), None if a % 9 == 0 else int(b), float(a)) for a, b in zip(rng.integers(0, 300_000, 4000), rng.integers(0, 1 << 40, 4000))]
    rows += rows[:500] + [(None, None, None)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, v double").repartition(5)
    row = sums_and_distinct(df, {"v": F.col("v")}, {"na": F.col("a"), "nb": F.col("b")}).first()
    assert (row.na, row.nb) == (len({r[0] for r in rows if r[0] is not None}), len({r[1] for r in rows if r[1] is not None}))
    assert row.v == sum(r[2] for r in rows if r[2] is not None)
    assert tuple(sums_and_distinct(df.limit(0), {"v": F.col("v")}, {"na": F.col("a")}).first()) == (None, 0)
