"""Neighbours of some rows only (knn_self_join with asks), and what SMOTE leaves on disk."""

import os
import time

import numpy as np
import pytest

from flowlens.operators import knn as KN
from flowlens.plans import fraud as FR
from flowlens.session import drop_written, ensure_checkpoint_dir, shuffles_dropped, written_once

SCHEMA = "id string, v array<double>, label int"


def points(seed, n):
    rng = np.random.default_rng(seed)
    return np.c_[rng.integers(1, 51, n), rng.integers(0, 3000, n) / 10, rng.integers(0, 11, n) / 100, rng.integers(0, 9, n) / 100].astype(float)


def folders(spark):
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {os.path.join(d, x) for d, dirs, _ in os.walk(top) for x in dirs}


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


@pytest.mark.parametrize("kind", ["plain", "copies", "repeated ids"])
def test_asks_get_what_all_rows_get(spark, kind, monkeypatch):
    monkeypatch.setattr(KN, "ASKS", 200)
    n, k = 700, 4
    x = points(3, n)
    if kind == "copies":
        x = x[np.random.default_rng(4).integers(0, n // 4, n)]
    ids = [f"r{i * 37 % 1009}" if kind != "repeated ids" or i % 9 else f"t{i % 5}" for i in range(n)]
    rows = [(i, v.tolist(), 1) for i, v in zip(ids, x)] + [("void", [None, 1.0, 1.0, 1.0], 1), ("none", None, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {}
    for r in KN.knn_self_join(df, "id", "v", k, n_pivots=6).collect():
        want[r.id, r["rank"]] = r.neighbor_id
    vectors = {}
    for i, v, _ in rows:
        vectors.setdefault(i, []).append(tuple(v or ()))
    asked = [(a, a % k + 1, *rows[a % len(rows)][:2]) for a in range(2 * len(rows))]
    asks = written_once(spark.createDataFrame(asked, "_ask long, _rank int, _id string, _v array<double>"), "asks")
    got = KN.knn_self_join(df, "id", "v", k, n_pivots=6, asks=asks)
    found = sorted((r["_ask"], r["_id"], tuple(r["_v"]), r.neighbor_id, tuple(r.neighbor)) for r in got.collect())
    drop_written(asks, got)
    assert found == sorted((a, i, tuple(v), nb, w) for a, r, i, v in asked if (i, r) in want for nb in [want[i, r]] for w in vectors[nb])


def test_smote_leaves_its_answers_only(spark):
    x = points(5, 4000)
    df = spark.createDataFrame([(f"r{i}", v.tolist(), int(i % 3 == 0)) for i, v in enumerate(x)], SCHEMA)
    before = folders(spark)
    made = KN.smote(df, "id", "v", "label")
    assert made.count() == 4000 - 2 * 1334
    left = {f for f in folders(spark) - before if os.path.isdir(f) and any(n.endswith(".parquet") or n.startswith("part-") for n in os.listdir(f))}
    assert left == {p.removeprefix("file:") for p in made.written_to}
    drop_written(made)
    assert not any(os.path.exists(p.removeprefix("file:")) for p in made.written_to)


def test_rebalancing_leaves_the_split_only(spark):
    """The split is written with flags, no hashes; SMOTE's tables are gone when its model is fitted."""
    x = points(6, 3000)
    rows = [(f"r{i}", *v.tolist(), int(i % 3 == 0)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id string, " + ", ".join(f"{c} double" for c in FR.FRAUD_FEATURES) + ", label int")
    before = folders(spark)
    out = FR.rebalancing_comparison(spark, df, n_iterations=2)
    left = [f for f in folders(spark) - before if any(n.endswith(".parquet") for n in os.listdir(f))]
    assert [os.path.basename(f).split("-")[0] for f in left] == ["split"]
    assert set(spark.read.parquet(left[0]).columns) == set(df.columns) | {"is_train"}
    assert {r.method: r.tp + r.fp + r.tn + r.fn for r in out.collect()} == dict.fromkeys(("class_weight", "undersample", "smote"), 600)


def test_written_tables_keep_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(key, None), shuffle_files(spark)
    table = written_once(spark.range(5000).repartition(4).groupBy("id").count(), "counted")
    with shuffles_dropped(spark):
        assert len(spark.range(100).repartition(4).groupBy("id").count().collect()) == 100
    for _ in range(50):  # they are removed in the background
        if not (left := {f for f in shuffle_files(spark) - before if f.endswith(".data")}):
            break
        time.sleep(0.2)
    assert not left
    assert table.count() == 5000
    drop_written(table)
    assert spark.conf.get(key, None) == was
