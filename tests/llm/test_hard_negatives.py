"""Hard negatives (11) against a full search in plain Python, and the intervals against true scores."""

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowlens.llm import hard_negatives as H
from flowlens.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, score string, v string, anchor string, code string"


def brute(rows, anchor=lambda i: i % 100 == 0, positives=5, negatives=10, low=30, high=90):
    """The answer over (id, vector, label) rows, by all pairs."""
    one = {}
    for i, x, label in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(256 * c) for c in x]
        one[i] = min(one.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in one.items():
        if not anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, other == label) for i, (other, w) in one.items() if i != a)
        for s, p, _ in [r for r in scored if r[2]][:positives]:
            fit = [r for r in scored if not r[2] and low * -s <= 100 * -r[0] <= high * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, anchor="vec_id % 100 = 0", **more):
    padded = [(*r, 7, "x", "x", "x", "x") for r in rows]
    return sorted(tuple(r) for r in H.hard_negatives(spark.createDataFrame(padded, SCHEMA), F.expr(anchor), F.col("label"), **more).collect())


def random_rows(seed, n, d, labels, scale=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(labels, d))
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        out.append((i, (scale * (middles[label] + 0.8 * rng.normal(size=d))).tolist(), label))
    return out


@pytest.mark.parametrize("n, d, labels", [(300, 64, 4), (250, 70, 3), (120, 3, 2), (90, 1, 3)])
def test_equal_to_a_full_search(spark, n, d, labels):
    rows = random_rows(n, n, d, labels)
    assert mined(spark, rows, "vec_id % 20 = 0") == brute(rows, lambda i: i % 20 == 0)


def test_small_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 4)
    monkeypatch.setattr(H, "CHUNK_ROWS", 16)
    rows = random_rows(9, 200, 16, 3)
    got = mined(spark, rows, "vec_id % 10 = 0", positives=3, negatives=4, low=10, high=95)
    assert got == brute(rows, lambda i: i % 10 == 0, 3, 4, 10, 95)


def test_query_and_sql_on_a_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(i, x, (label + 1) % 10 if i % 7 == 0 else label) for i, x, label in rows]
    got = sorted(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, small).collect())
    assert got == brute(rows) and got
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    assert sorted(db.sql(ORACLE["op11_hard_negatives"]).fetchall()) == got


def test_edges(spark):
    rng = random.Random(1)
    same = [1.0, 2.0, -0.5]
    rows = [(i, same, i % 3) for i in range(60)]  # ties everywhere
    rows += [(i, [rng.uniform(-1, 1) for _ in range(3)], i % 3) for i in range(60, 120)]
    rows += [(100, same, 1), (100, same, 1), (7, same, 1), (7, [0.0, 0.0, 0.0], 0)]  # repeated ids
    rows += [(200, None, 1), (201, same, None), (None, same, 1), (202, [1.0, None, 1.0], 1), (203, [1.0, math.nan, 1.0], 2), (204, [math.inf, 0.0, 0.0], 0)]
    rows += [(300, [1.0], 1), (301, [], 2), (400, [-0.0, 0.0, 0.0], 2)]  # short, empty and zero vectors
    rows += [(500, same, -3), (501, same, 9)]  # a label with no other row
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, rows[:1]) == [] and mined(spark, rows, "vec_id < 0") == []
    nothing = spark.createDataFrame([(1, same, 1)], "vec_id long, embedding array<double>, label int").where("vec_id = 2")
    assert H.hard_negatives(nothing, F.lit(True), F.col("label")).count() == 0


def test_numbers_beyond_exact_doubles(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 2**22 for _ in range(8)], i % 2) for i in range(60)]
    assert mined(spark, rows, "vec_id % 15 = 0") == brute(rows, lambda i: i % 15 == 0)
    huge = [(i, [1e300 * (i + 1), -1e300], i % 2) for i in range(6)]
    assert all(r[4] <= 2**63 - 1 for r in mined(spark, huge, "vec_id = 0"))


def table_of(rows, d):
    v = np.array([[math.floor(256 * c) for c in x] for _, x, _ in rows], np.int64).reshape(-1, d)
    return H.Coded(np.array([r[0] for r in rows]), np.array([r[2] for r in rows]), v, *H.encode(v))


@pytest.mark.parametrize("d", [1, 5, 64, 100])
def test_intervals_hold_the_scores(d):
    rows = table_of(random_rows(d, 200, d, 3), d)
    n = 40
    queries = H.Queries(rows.part(slice(0, n)), np.zeros((n, 1)), np.zeros((n, 1)), 5, True)
    lo, hi = queries.intervals(rows)
    true, exact = queries.scores(rows)
    assert exact and (lo <= true).all() and (true <= hi).all()
    size = rows.norm[:n, None] * rows.norm
    assert (hi - lo).mean() < (0.6 if d > 1 else 2) * size.mean() and np.corrcoef(((lo + hi) / 2).ravel(), true.ravel())[0, 1] > 0.9


def test_intervals_drop_pairs_that_cannot_count():
    """With rows in a few directions most pairs need no score."""
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(20, 64))
    rows = [(i, (middles[i % 20] * (1 + 0.01 * rng.normal())).tolist(), i // 20 % 2) for i in range(2000)]
    coded = table_of(rows, 64)
    first = coded.part(slice(0, 20))
    best = H.Best(H.Queries(first, np.full((20, 1), -(1 << 62)), np.full((20, 1), 1 << 62), 5, True))
    for k in range(0, 2000, 100):
        best.add(coded.part(slice(k, k + 100)))
    assert best.survivors < 0.2 * best.pairs
    true = (first.v @ coded.v.T).astype(np.int64)
    for a in range(20):
        want = sorted((-true[a, j], j) for j in range(2000) if rows[j][2] == rows[a][2] and j != a)[:5]
        assert sorted((-s, i) for s, i in zip(best.score[best.slot == a].tolist(), best.ids[best.slot == a].tolist())) == want


def test_lists_of_any_offset_are_read():
    lists = pa.array([[9], [1, 2], [], [3]], pa.list_(pa.int64())).slice(1)
    assert H.matrix(lists, 2).tolist() == [[1, 2], [0, 0], [3, 0]]
