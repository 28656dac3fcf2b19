"""Gradient descent against a numpy loop; evaluation against brute force; kNN and SMOTE."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.operators import evaluate as EV
from flowlens.operators import knn as KN
from flowlens.operators import linear as LN
from flowlens.operators.scaling import standardize
from flowlens.plans.fraud import split_and_scale


def np_gd(X, y, lr, iters, l2=0.0, l2_bias=False, mean=True, clip=None, w_s=None, patience=None):
    Xb = np.c_[np.ones(len(X)), X]
    w = np.zeros(Xb.shape[1])
    s = np.ones(len(y)) if w_s is None else w_s
    best, best_w, stall = np.inf, w.copy(), 0
    for _ in range(iters):
        z = Xb @ w
        if clip is not None:
            z = np.clip(z, -clip, clip)
        h = 1 / (1 + np.exp(-z))
        g = Xb.T @ ((h - y) * s)
        if mean:
            g = g / len(y)
        reg = l2 * w
        if not l2_bias:
            reg[0] = 0.0
        w = w - lr * (g + reg)
        if patience is not None:
            z = Xb @ w
            if clip is not None:
                z = np.clip(z, -clip, clip)
            p = np.clip(1 / (1 + np.exp(-z)), 1e-15, 1 - 1e-15)
            loss = np.mean((-y * np.log(p) - (1 - y) * np.log(1 - p)) * s) + 0.5 * l2 * np.sum((w if l2_bias else w[1:]) ** 2)
            if loss < best:
                best, best_w, stall = loss, w.copy(), 0
            else:
                stall += 1
                if stall >= patience:
                    break
    return best_w if patience is not None else w


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(400, 3))
    y = (X @ np.array([1.5, -2.0, 0.5]) + rng.normal(size=400) > 0.3).astype(int)
    df = spark.createDataFrame([(int(i), *map(float, x), int(t)) for i, (x, t) in enumerate(zip(X, y))],
                               "id bigint, a double, b double, c double, label int")
    return df, X, y


@pytest.mark.parametrize("cfg", [
    dict(lr=0.1, iters=15),
    dict(lr=0.1, iters=10, l2=0.1, l2_bias=True),
    dict(lr=0.5, iters=10, l2=0.01, clip=20.0),
    dict(lr=0.001, iters=5, mean=False),
])
def test_gd_matches_numpy(data, cfg):
    df, X, y = data
    g = LN.GDConfig(learning_rate=cfg["lr"], n_iterations=cfg["iters"], l2=cfg.get("l2", 0.0),
                    l2_bias=cfg.get("l2_bias", False), mean_gradient=cfg.get("mean", True), clip_z=cfg.get("clip"))
    res = LN.fit_logistic_gd(df, ["a", "b", "c"], "label", g)
    want = np_gd(X, y, cfg["lr"], cfg["iters"], cfg.get("l2", 0.0), cfg.get("l2_bias", False), cfg.get("mean", True), cfg.get("clip"))
    np.testing.assert_allclose(res.weights, want, rtol=1e-9, atol=1e-12)
    assert len(res.history) == cfg["iters"]


def test_gd_early_stop_keeps_best(data):
    df, X, y = data
    cfg = LN.GDConfig(learning_rate=5.0, n_iterations=40, l2=0.01, clip_z=20.0, patience=3)
    res = LN.fit_logistic_gd(df, ["a", "b", "c"], "label", cfg)
    want = np_gd(X, y, 5.0, 40, 0.01, False, True, 20.0, patience=3)
    np.testing.assert_allclose(res.weights, want, rtol=1e-9, atol=1e-12)


def test_balanced_estimator_and_predict(spark, data):
    df, X, y = data
    m = LN.LogisticRegressionGD(0.1, 10, class_weight="balanced").fit(df, ["a", "b", "c"])
    n, n1 = len(y), y.sum()
    s = np.where(y == 1, n / (2 * n1), n / (2 * (n - n1)))
    np.testing.assert_allclose(m.weights, np_gd(X, y, 0.1, 10, w_s=s), rtol=1e-9, atol=1e-12)
    pred = m.predict(df, 0.5)
    assert set(r.prediction for r in pred.select("prediction").distinct().collect()) <= {0, 1}
    coef = LN.coefficient_table(spark, m.weights, ["a", "b", "c"]).collect()
    assert [abs(r.coefficient) for r in coef] == sorted([abs(w) for w in m.weights[1:]], reverse=True)


def brute(scores, labels, t):
    p = scores >= t
    tp = int(np.sum(p & (labels == 1)))
    fp = int(np.sum(p & (labels == 0)))
    tn = int(np.sum(~p & (labels == 0)))
    fn = int(np.sum(~p & (labels == 1)))
    return tp, fp, tn, fn


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    s = np.round(rng.random(1500), 2)  # many ties
    l = (rng.random(1500) < s).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, l)], "probability double, label int")
    return df, s, l


def test_threshold_metrics(scored):
    df, s, l = scored
    ts = [0.1 + i * 0.01 for i in range(40)]
    got = {r.threshold: (r.tp, r.fp, r.tn, r.fn) for r in EV.threshold_metrics(df, ts).collect()}
    for t in ts:
        assert got[t] == brute(s, l, t)


def test_auc_with_ties(scored):
    df, s, l = scored
    pos, neg = s[l == 1], s[l == 0]
    want = (np.sum(pos[:, None] > neg[None, :]) + 0.5 * np.sum(pos[:, None] == neg[None, :])) / (len(pos) * len(neg))
    assert abs(EV.roc_auc(df).first().auc - round(want, 6)) < 1e-9


def test_pr_curve_and_best(scored):
    df, s, l = scored
    curve = {r.threshold: r for r in EV.pr_curve(df).collect()}
    for t in sorted(set(s)):
        if t < s[l == 1].min():
            assert t not in curve
            continue
        tp, fp, _, fn = brute(s, l, t)
        assert (curve[t].tp, curve[t].fp) == (tp, fp)
    best = EV.best_f1_threshold(EV.pr_curve(df)).first()
    f1s = {t: 2 * r.precision * r.recall / (r.precision + r.recall) for t, r in curve.items() if r.precision + r.recall > 0}
    assert abs(best.f1 - round(max(f1s.values()), 6)) < 1e-6


def test_grid_prefers_the_larger_f1_however_close(spark):
    """One false positive among four million: 0.11 has the larger F1, by less than 1e-6."""
    df = spark.range(4_000_000).selectExpr("0.9D AS probability", "1 AS label").unionByName(
        spark.createDataFrame([(0.105, 0)], "probability double, label int"))
    assert EV.grid_best_threshold(df, [0.10, 0.11, 0.12]).first().best_threshold == 0.11


def test_best_threshold_is_not_rounded(spark):
    rows = [(0.1234567891, 1), (0.12345678905, 0), (0.1234567889, 1)]
    df = spark.createDataFrame(rows, "probability double, label int")
    curve = EV.pr_curve(df)
    assert curve.count() == 3
    assert EV.best_f1_threshold(curve).first().best_threshold == 0.1234567889


def test_curve_has_a_point_for_every_score(spark):
    from flowlens.plans import fraud as FR
    from flowlens.sources.adapters import labelled_view
    from tests.conftest import SF_SMALL

    scored = FR.exact_scored_test(labelled_view(spark, SF_SMALL))
    low = scored.filter("label = 1").agg({"probability": "min"}).first()[0]
    assert EV.pr_curve(scored).count() == scored.filter(f"probability >= {low!r}").select("probability").distinct().count()


def test_smote_needs_a_neighbour(spark):
    from flowlens.operators.knn import smote

    df = spark.createDataFrame([(i, [float(i)], int(i == 0)) for i in range(9)], "id bigint, v array<double>, label int")
    with pytest.raises(ValueError):
        smote(df, "id", "v", "label")


def test_grid_default_when_no_f1(spark):
    df = spark.createDataFrame([(0.01, 1), (0.02, 0)], "probability double, label int")
    r = EV.grid_best_threshold(df, [0.1 + i * 0.01 for i in range(40)]).first()
    assert (r.best_threshold, r.best_f1) == (0.5, 0.0)


def test_classification_report(scored):
    df, s, l = scored
    rep = {r["class"]: r for r in EV.classification_report(df.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))).collect()}
    tp, fp, tn, fn = brute(s, l, 0.5)
    assert rep["1"].support == tp + fn and rep["0"].support == tn + fp
    assert rep["1"].precision == round(tp / (tp + fp), 6)
    assert rep["accuracy"].precision == round((tp + tn) / len(s), 6)


@pytest.mark.parametrize("pivots,block", [(1, 4096), (3, 4096), (8, 4096), (1, 25), (3, 8)])
def test_knn_exact(spark, pivots, block):
    rng = np.random.default_rng(3)
    V = rng.normal(size=(120, 6))
    V[5] = V[6]  # a duplicate point
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(V)], "id bigint, v array<double>")
    got = {(r.id, r["rank"]): r.neighbor_id
           for r in KN.knn_self_join(df, "id", "v", k=4, n_pivots=pivots, block_rows=block).collect()}
    D = np.sqrt(((V[:, None, :] - V[None, :, :]) ** 2).sum(-1))
    for i in range(len(V)):
        order = sorted((D[i, j], j) for j in range(len(V)) if j != i)[:4]
        for r, (_, j) in enumerate(order, start=1):
            assert got[(i, r)] == j


def test_smote_points_on_segments(spark):
    rng = np.random.default_rng(4)
    V = rng.normal(size=(60, 4))
    lab = [1 if i < 15 else 0 for i in range(60)]
    df = spark.createDataFrame([(int(i), [float(x) for x in v], l) for i, (v, l) in enumerate(zip(V, lab))],
                               "id bigint, v array<double>, label int")
    syn = KN.smote(df, "id", "v", "label", k=3, ratio=1.0).collect()
    assert len(syn) == 45 - 15
    for r in syn:
        b, nb = V[r.base_id], V[r.neighbor_id]
        np.testing.assert_allclose(r.v, b + r.gap * (nb - b), rtol=1e-12, atol=1e-12)
        assert lab[r.base_id] == 1 and lab[r.neighbor_id] == 1 and 0 <= r.gap < 1


def test_standardize_fit_on_train(spark, data):
    df, X, _ = data
    out = standardize(df, ["a"], fit_on=df.filter("id < 200")).orderBy("id").collect()
    mu, sd = X[:200, 0].mean(), X[:200, 0].std()
    np.testing.assert_allclose([r.a for r in out], (X[:, 0] - mu) / sd, rtol=1e-9)


def test_wide_blocks_and_null_rows(spark):
    """80 features (partial sums added by a shuffle), and a row with a NULL that counts in the mean only."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 80))
    y = (x[:, 0] + rng.normal(size=300) > 0).astype(float)
    names = [f"f{i}" for i in range(80)]
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows + [(None, *map(float, x[0, 1:]), 1.0)], ", ".join(f"{c} double" for c in [*names, "label"]))
    res = LN.fit_logistic_gd(df, names, "label", LN.GDConfig(learning_rate=0.1, n_iterations=4))
    w = np.zeros(81)
    xb = np.hstack([np.ones((300, 1)), x])
    for _ in range(4):
        w -= 0.1 * (xb.T @ (1 / (1 + np.exp(-xb @ w)) - y)) / 301
    np.testing.assert_allclose(res.weights, w, rtol=1e-9, atol=1e-12)
    assert LN.fit_logistic_gd(df.limit(0), names, "label", LN.GDConfig(n_iterations=2)).weights == [0.0] * 81


def brute_knn(rows, k):
    """(id, neighbour, rank) by (distance, id) over rows (id, vector) of unique ids; rows with a null have none."""
    whole = [(i, np.array(v)) for i, v in rows if v is not None and None not in v]
    out = []
    for i, v in whole:
        near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in whole if j != i)[:k]
        out += [(i, j, r) for r, (_, j) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("cell_rows", [4, 16, 1024])
def test_knn_of_copies_grids_and_null_rows(spark, monkeypatch, cell_rows):
    """Many copies of few vectors, equal distances on a grid, text ids, rows with nulls: as brute force."""
    monkeypatch.setattr(KN, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(2)
    rows = [(f"g{i}", [float(x) for x in v]) for i, v in enumerate(rng.integers(0, 5, (150, 3)))]
    rows += [(f"c{i}", [9.0, 9.0, float(i % 2)]) for i in range(60)] + [(f"r{i}", [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(60, 3)))]
    rows += [("n1", None), ("n2", [1.0, None, 2.0])]
    df = spark.createDataFrame(rows, "id string, v array<double>").repartition(3)
    got = KN.knn_self_join(df, "id", "v", k=4)
    assert sorted((r.id, r.neighbor_id, r["rank"]) for r in got.collect()) == brute_knn(rows, 4)
    assert KN.knn_self_join(df.limit(0), "id", "v", k=4).count() == 0


def test_knn_holds_a_tile_at_a_time(spark, monkeypatch):
    """A cell of 3,000 wide vectors in tiles of 30,000 distances: no array of a task has an entry for each pair and component."""
    monkeypatch.setattr(KN, "TILE", 30_000)
    rng = np.random.default_rng(6)
    V = rng.normal(size=(3000, 64))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(V)], "id bigint, v array<double>")
    got = {(r.id, r["rank"]): r.neighbor_id for r in KN.knn_self_join(df, "id", "v", k=3, n_pivots=1).where("id < 40").collect()}
    for i in range(40):
        D = np.sqrt(((V[i] - V) ** 2).sum(axis=1))
        D[i] = np.inf
        assert [got[i, r] for r in (1, 2, 3)] == np.argsort(D)[:3].tolist()


def test_gd_blocks_reach_workers_in_small_batches(spark, data):
    """Without weights a block carries none, and a batch to a worker is bounded however many rows there are."""
    df, _, _ = data
    LN.fit_logistic_gd(df, ["a", "b", "c"], "label", LN.GDConfig(n_iterations=1))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 4 << 20
    assert LN.pack_blocks(df, ["a", "b", "c"], "label").agg(F.sum(F.length("s"))).first()[0] == 0
    assert LN.pack_blocks(df, ["a", "b", "c"], "label", "a").agg(F.sum(F.length("s"))).first()[0] == 8 * 400


def test_class_sizes_and_bounds_take_few_runs(spark, monkeypatch):
    """A split of two classes with large buckets reads the rows twice: counts by prefix, then the boundary rows of all classes."""
    from flowlens.operators import ranking as RK
    from flowlens.operators.sampling import stratified_split

    seen = spark.sparkContext.accumulator(0)

    def tick(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(30_000).selectExpr("id", "cast(id % 2 as int) as label").mapInArrow(tick, "id long, label int")
    out = stratified_split(df, "id", "label")
    assert seen.value == 60_000
    assert out.where("is_train").count() == 24_000


def test_split_and_scale_works_its_statistics_out_once(data):
    """Each use of the frame (blocks, class weights, test rows) would run the aggregate over all rows again."""
    df, X, _ = data
    out = split_and_scale(df.withColumnRenamed("id", "row_id"), ["a", "b", "c"])
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    train = np.array([[r.a, r.b, r.c] for r in out.filter("is_train").collect()])
    np.testing.assert_allclose(train.mean(axis=0), 0, atol=1e-12)
    np.testing.assert_allclose(train.std(axis=0), 1, atol=1e-12)


def test_pass_over_persisted_blocks(data):
    """A pass takes the blocks' bytes as they are kept: gradient, loss, rows and right predictions together."""
    df, X, y = data
    blocks = LN.pack_blocks(df, ["a", "b", "c"], "label").rdd.map(lambda r: (r[0], bytes(r[1]), bytes(r[2]), bytes(r[3]))).persist()
    w = np.array([0.1, 0.5, -1.0, 0.2])
    h = 1 / (1 + np.exp(-(w[0] + X @ w[1:])))
    g, loss, n, right = LN._pass(blocks, w, LN.GDConfig())
    blocks.unpersist()
    np.testing.assert_allclose(g, np.c_[np.ones(len(X)), X].T @ (h - y), rtol=1e-9)
    assert loss == pytest.approx(-np.sum(np.log(np.where(y == 1, h, 1 - h))))
    assert (n, right) == (len(y), int(((h >= 0.5) == (y == 1)).sum()))


def test_training_reads_its_rows_once(spark):
    """Split, statistics, class weights and blocks take the rows as written with their hashes, not the source again."""
    seen = spark.sparkContext.accumulator(0)

    def tick(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    cols = "cast(id as string) as row_id, id % 11 / 11 as a, id % 7 / 7 as b, cast(id % 4 = 0 as int) as label"
    df = spark.range(2000).selectExpr(*cols.split(", ")).mapInArrow(tick, "row_id string, a double, b double, label int")
    data = split_and_scale(df, ["a", "b"], columns=["a", "b", "label"])
    m = LN.LogisticRegressionGD(0.1, 2, class_weight="balanced").fit(data.filter("is_train"), ["a", "b"])
    assert m.predict(data.filter("NOT is_train")).count() == 400
    assert seen.value == 2000
