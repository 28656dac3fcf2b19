"""Logistic regression by full-batch gradient descent.

Training rows are packed into blocks (Arrow batches as matrices) and persisted once, as serialized bytes that go to
the Python workers block by block as they are, so a worker's memory doesn't grow with the rows and a pass converts
nothing; each iteration is ONE job over the blocks that returns gradient, loss and training accuracy together (the
reference ran three jobs and recounted the rows every iteration). Blocks are recomputed if an executor is lost. The
job is the same at every pass and for any number of features; only the d+1 weights live on the driver. For scoring,
the dot product is an unrolled column expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import bound_batches

EPS = 1e-15


def logit(weights: Sequence[float], features: Sequence[str], clip_z: float | None = None) -> Column:
    """z = b + Σ w_i x_i (weights[0] is the bias), optionally clipped to ±clip_z."""
    z = F.lit(float(weights[0]))
    for w, c in zip(weights[1:], features):
        z = z + F.lit(float(w)) * F.col(c)
    if clip_z is not None:
        z = F.least(F.greatest(z, F.lit(-clip_z)), F.lit(clip_z))
    return z


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def predict_proba(df: DataFrame, weights: Sequence[float], features: Sequence[str], name: str = "probability",
                  clip_z: float | None = None) -> DataFrame:
    return df.withColumn(name, sigmoid(logit(weights, features, clip_z)))


def predict(df: DataFrame, prob: str = "probability", threshold: float = 0.5, strict: bool = False, name: str = "prediction") -> DataFrame:
    """1 when p ≥ threshold (p > threshold when ``strict``)."""
    cond = F.col(prob) > threshold if strict else F.col(prob) >= threshold
    return df.withColumn(name, F.when(cond, 1).otherwise(0))


def log_loss_expr(label: Column, p: Column, eps: float = EPS, binary: bool = False) -> Column:
    """ε-clipped binary cross-entropy of one row.

    With ``binary`` (labels exactly 0 or 1) one logarithm per row: -log(p) or -log(1 - p),
    the same value as the two-term form.
    """
    pc = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    if binary:
        return -F.log(F.when(label == 1.0, pc).otherwise(F.lit(1.0) - pc))
    return -label * F.log(pc) - (F.lit(1.0) - label) * F.log(F.lit(1.0) - pc)


def log_loss(scored: DataFrame, label: str = "label", prob: str = "probability", weight: str | None = None) -> DataFrame:
    """Mean (optionally weighted) log-loss as a one-row DataFrame."""
    row = log_loss_expr(F.col(label).cast("double"), F.col(prob))
    if weight:
        row = row * F.col(weight)
    return scored.agg(F.avg(row).alias("log_loss"))


@dataclass
class GDConfig:
    learning_rate: float = 0.01
    n_iterations: int = 100
    l2: float = 0.0                 # λ
    l2_bias: bool = False           # T3 regularises every weight, T4 not the bias
    mean_gradient: bool = True      # T5 uses the summed gradient
    clip_z: float | None = None     # T4 clips z to ±20
    weight_col: str | None = None   # T6/T7 class weights
    patience: int | None = None     # T4: stop after this many non-improving losses, keep the best


@dataclass
class GDResult:
    weights: list[float]
    history: list[tuple[int, float, float]] = field(default_factory=list)  # (iteration, loss, accuracy)
    iterations: int = 0

    def history_df(self, spark: SparkSession) -> DataFrame:
        """(iteration, loss, train accuracy) — one row per iteration run."""
        return spark.createDataFrame(self.history, "iteration int, loss double, accuracy double")


def pack_blocks(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None) -> DataFrame:
    """The rows as blocks, one for each Arrow batch: n, x (d × n' doubles, feature by feature), y and s (n' doubles; no weight: s empty).

    Blocks keep the frame's partitions. A row with a NULL in any of the columns counts in n (so in the mean), but
    has no gradient or loss: the block's n' other rows have.
    """
    d = len(features)

    def pack(batches):
        # nested, so that it is shipped by value: executors need numpy and pyarrow, not this package
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            m = np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns])
            whole = m[:, ~np.isnan(m).any(axis=0)]
            parts = [whole[:d], whole[d], whole[d + 1 :]]
            row = [pa.array([batch.num_rows], pa.int64()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts)]
            yield pa.RecordBatch.from_arrays(row, ["n", "x", "y", "s"])

    cols = [F.col(c).cast("double") for c in [*features, label, *([weight] if weight else [])]]
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(pack, "n long, x binary, y binary, s binary")


COLLECT_FEATURES = 64  # beyond this the tasks' partial sums are added up by a shuffle, else by the driver (one row a task)


def _pass(blocks: RDD, w: Sequence[float], cfg: GDConfig):
    """Gradient, loss, row count and right predictions at w: a task turns each block into a matrix and adds up its sums.

    The job is the same at every pass, whatever the number of features; only the weights that go along differ.
    """
    clip, eps, d = cfg.clip_z, EPS, len(w) - 1
    weights = list(w)

    def sums(part):
        import numpy as np

        b, v = weights[0], np.array(weights[1:])
        total = np.zeros(d + 4)
        for n, *raw in part:
            y = np.frombuffer(raw[1])
            x = np.frombuffer(raw[0]).reshape(d, len(y))
            one = y == 1.0
            # in place: a pass touches each row's doubles as few times as it can
            z = v @ x
            z += b
            if clip is not None:
                np.clip(z, -clip, clip, out=z)
            with np.errstate(over="ignore"):
                e = np.exp(np.negative(z, out=z), out=z)
            e += 1.0
            np.reciprocal(e, out=e)
            right = np.count_nonzero((e >= 0.5) == one)
            p = np.clip(e, eps, 1.0 - eps)
            loss = 1.0 - p
            np.copyto(loss, p, where=one)
            np.log(loss, out=loss)
            e -= y
            if raw[2]:
                s = np.frombuffer(raw[2])
                e *= s
                loss *= s
            total[0] += e.sum()
            total[1 : d + 1] += x @ e
            total[d + 1 :] += -loss.sum(), n, right
        yield total.tolist()

    parts = blocks.mapPartitions(sums)
    if d <= COLLECT_FEATURES:
        rows = parts.collect()
        total = [math.fsum(c) for c in zip(*rows)] or [0.0] * (d + 4)
    else:
        total = [0.0] * (d + 4)
        for i, v in parts.flatMap(enumerate).reduceByKey(lambda a, b: a + b).collect():
            total[i] = v
    return total[: d + 1], total[d + 1], int(total[d + 2]), int(total[d + 3])


def _reg(w: Sequence[float], cfg: GDConfig) -> float:
    ws = w if cfg.l2_bias else w[1:]
    return 0.5 * cfg.l2 * sum(x * x for x in ws)


def fit_logistic_gd(df: DataFrame, features: Sequence[str], label: str, cfg: GDConfig,
                    init: Sequence[float] | None = None) -> GDResult:
    """W ← w - lr · (g / n + λ w). One job per iteration over the persisted blocks of rows.

    The loss recorded for iteration i is the loss at the updated weights (as in the
    reference), which is exactly what the next iteration's aggregate computes anyway.
    """
    bound_batches(df.sparkSession)
    # the plan runs once: its blocks' bytes are kept
    packed = pack_blocks(df, features, label, cfg.weight_col).rdd.map(lambda r: (r[0], bytes(r[1]), bytes(r[2]), bytes(r[3])))
    cores = df.sparkSession.sparkContext.defaultParallelism
    if packed.getNumPartitions() < cores:  # a small file in one split: spread its blocks once for all passes
        packed = packed.repartition(cores)
    train = packed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        w = [0.0] * (len(features) + 1) if init is None else [float(x) for x in init]
        g, _, n, _ = _pass(train, w, cfg)
        res = GDResult(weights=list(w))
        best_loss, best_w, stall = math.inf, list(w), 0
        for it in range(cfg.n_iterations):
            scale = 1.0 / n if (cfg.mean_gradient and n) else 1.0
            step = []
            for j, gj in enumerate(g):
                reg = cfg.l2 * w[j] if (cfg.l2 and (j > 0 or cfg.l2_bias)) else 0.0
                step.append(gj * scale + reg)
            w = [wj - cfg.learning_rate * sj for wj, sj in zip(w, step)]
            g, loss_sum, n, correct = _pass(train, w, cfg)
            loss = (loss_sum / n if n else 0.0) + _reg(w, cfg)
            res.history.append((it, loss, correct / n if n else 0.0))
            res.iterations = it + 1
            if cfg.patience is None:
                continue
            if loss < best_loss:
                best_loss, best_w, stall = loss, list(w), 0
            else:
                stall += 1
                if stall >= cfg.patience:
                    break
        res.weights = best_w if cfg.patience is not None else w
        return res
    finally:
        train.unpersist()


class LogisticRegressionGD:
    """Estimator-style wrapper — fit / predict_proba / predict(threshold)."""

    def __init__(self, learning_rate: float = 0.01, n_iterations: int = 1000, class_weight: str | None = None, **kw):
        self.cfg = GDConfig(learning_rate=learning_rate, n_iterations=n_iterations, **kw)
        self.class_weight = class_weight
        self.result: GDResult | None = None
        self.features: list[str] = []

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "label") -> "LogisticRegressionGD":
        from flowlens.operators.sampling import balanced_weights

        self.features = list(features)
        if self.class_weight == "balanced":
            df = balanced_weights(df, label, "_cw")
            self.cfg.weight_col = "_cw"
        self.result = fit_logistic_gd(df, self.features, label, self.cfg)
        return self

    @property
    def weights(self) -> list[float]:
        assert self.result is not None, "fit first"
        return self.result.weights

    def predict_proba(self, df: DataFrame, name: str = "probability") -> DataFrame:
        return predict_proba(df, self.weights, self.features, name, self.cfg.clip_z)

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return predict(self.predict_proba(df), "probability", threshold)


def coefficient_table(spark: SparkSession, weights: Sequence[float], names: Sequence[str], include_bias: bool = False) -> DataFrame:
    """(feature, coefficient, abs_value) ordered by |coefficient| desc — d rows."""
    rows = list(zip(names, weights[1:]))
    if include_bias:
        rows = [("intercept", weights[0])] + rows
    from flowlens.operators.topk import sort_by_abs

    df = spark.createDataFrame([(n, float(w)) for n, w in rows], "feature string, coefficient double")
    return sort_by_abs(df, "coefficient", "feature")
