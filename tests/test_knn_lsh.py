"""Bucket join of nearest neighbours: recall against brute force, exact distances, copies, small and empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.operators import knn_lsh as L
from flowlens.operators.knn import smote

SCHEMA = "id long, v array<float>"


def frame(spark, x, first=0):
    return spark.createDataFrame([(i + first, v.tolist()) for i, v in enumerate(x.astype("float32"))], SCHEMA)


def brute(x, k, ids):
    x = x.astype("float32").astype(float)
    d = np.sqrt(((x[ids][:, None] - x[None]) ** 2).sum(axis=2))
    d[np.arange(len(ids)), ids] = np.inf
    return {i: {j: row[j] for j in np.lexsort((np.arange(len(x)), row))[:k]} for i, row in zip(ids, d)}


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["id"], []).append((r["rank"], r["neighbor_id"], r["distance"]))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("spread", [0.3, None])
def test_recall_and_exact_distances(spark, spread):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 32))
    if spread:
        x = rng.standard_normal((30, 32))[rng.integers(30, size=1500)] + spread * x
    got = answers(L.knn_lsh_join(frame(spark, x), "id", "v", query=F.col("id") % 20 == 0, bucket_rows=64, tile_rows=100))
    want = brute(x, 5, np.arange(0, 1500, 20))
    assert set(got) == set(want)
    hit = 0
    for i, rows in got.items():
        assert [r for r, _, _ in rows] == [1, 2, 3, 4, 5] and len({s for _, s, _ in rows}) == 5 and i not in {s for _, s, _ in rows}
        assert [d for _, _, d in rows] == sorted(d for _, _, d in rows)
        for _, s, d in rows:
            assert d == pytest.approx(np.linalg.norm(x[i].astype("float32").astype(float) - x[s].astype("float32").astype(float)), abs=1e-9)
            hit += s in want[i]
    assert hit >= 0.9 * 5 * len(want)


def test_clusters_need_few_pairs(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((64, 32))[np.arange(4096) % 64] + 0.05 * rng.standard_normal((4096, 32))
    q, near = x[:64], np.stack([x[i + 64 * np.arange(1, 6)] for i in range(64)])
    bits, tables, probes = L.choose(q, near, np.ones((64, 5), bool), 4096, 0.95, 42, 64)
    assert tables * probes / 2**bits < 0.2


def test_a_third_of_all_rows_is_one_vector(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([np.tile(rng.standard_normal(8), (400, 1)), rng.standard_normal((800, 8))])
    got = answers(L.knn_lsh_join(frame(spark, x), "id", "v", k=3, query=F.col("id") % 50 == 0, bucket_rows=64, tile_rows=50))
    assert [s for _, s, _ in got[0]] == [1, 2, 3] and [s for _, s, _ in got[350]] == [0, 1, 2]
    assert all(len(v) == 3 for v in got.values()) and len(got) == 24


def test_small_empty_and_null_rows(spark):
    few = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, None), (None, [5.0, 5.0])], SCHEMA)
    assert answers(L.knn_lsh_join(few, "id", "v")) == {
        1: [(1, 2, 1.0), (2, 3, 2.0)], 2: [(1, 1, 1.0), (2, 3, pytest.approx(5**0.5))], 3: [(1, 1, 2.0), (2, 2, pytest.approx(5**0.5))],
    }
    assert L.knn_lsh_join(few.limit(0), "id", "v").count() == 0
    assert L.knn_lsh_join(few.where("id = 1"), "id", "v").count() == 0
    assert L.knn_lsh_join(few, "id", "v", query=F.lit(False)).count() == 0


def test_smote_takes_the_join(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((120, 6))
    df = frame(spark, x).withColumn("label", (F.col("id") < 40).cast("int"))
    nn = L.knn_lsh_join(df.where("label = 1"), "id", "v", bucket_rows=8)
    made = smote(df, "id", "v", "label", ratio=1.0, knn=nn).collect()
    assert len(made) == 40 and all(r["base_id"] < 40 and r["neighbor_id"] < 40 for r in made)
