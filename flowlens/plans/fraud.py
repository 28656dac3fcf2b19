"""Fraud-style classification flow: split → scale → train → score → evaluate.

Works on any labelled frame with a row key, feature columns and a 0/1 label; the registered
queries use ``adapters.labelled_view`` (four lineitem measures, label = returned).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators import evaluate as EV
from flowlens.operators.linear import GDConfig, LogisticRegressionGD, fit_logistic_gd, predict, predict_proba
from flowlens.operators.sampling import stratified_split, undersample_ratio
from flowlens.operators.scaling import apply_standardizer, fit_standardizer
from flowlens.session import cut_lineage, drop_written, written_once
from flowlens.sources.adapters import FRAUD_FEATURES

SEED = 42
TEST_SIZE = 0.2
# fixed model used by the evaluation queries: bias, then one weight per feature in FRAUD_FEATURES order
FIXED_WEIGHTS = [-0.7, 0.05, 0.4, -0.3, 0.2]


def split_and_scale(labelled: DataFrame, features: Sequence[str] = FRAUD_FEATURES, key: str = "row_id",
                    label: str = "label", test_size: float = TEST_SIZE, seed: int = SEED,
                    columns: Sequence[str] | None = None, flags_only: bool = False) -> DataFrame:
    """M2 + M11/M12: stratified split flag, then features standardised with train statistics.

    The rows' hashes and the statistics, one row, are worked out once for all uses of the result. ``columns`` are those
    that the result has beside the flag: all of ``labelled``, or fewer, but features and label. With ``flags_only`` the flags
    are written instead of the hashes, which no codec shortens: keys are hashed more often, but the table is less than half as long.
    """
    once = columns or labelled.columns
    if flags_only:
        flagged = written_once(stratified_split(labelled, key, label, test_size, seed, "is_train").select(*once, "is_train"), "split")
    else:
        flagged = stratified_split(labelled, key, label, test_size, seed, "is_train", once=once)
    params = cut_lineage(fit_standardizer(flagged.filter("is_train"), features, zero_std_to_one=True))
    return apply_standardizer(flagged, params, features)


def scored_test(spark: SparkSession, labelled: DataFrame, weights: Sequence[float] = FIXED_WEIGHTS,
                features: Sequence[str] = FRAUD_FEATURES) -> DataFrame:
    """Test rows of the split with ``probability`` and hard ``prediction`` at 0.5."""
    test = split_and_scale(labelled, features).filter(~F.col("is_train"))
    return predict(predict_proba(test, weights, features), "probability", 0.5)


# integer weights of a linear score over cents and hundredths: any engine computes it without rounding
EXACT_WEIGHTS = [7, 2, -90_000, 40_000]


def exact_scored_test(labelled: DataFrame, features: Sequence[str] = FRAUD_FEATURES, weights: Sequence[int] = EXACT_WEIGHTS) -> DataFrame:
    """Test rows of the split with an exact linear score (whole numbers in a double) as ``probability``.

    A threshold curve depends on the order of the scores only, and a logistic link keeps it.
    """
    test = stratified_split(labelled, "row_id", "label", TEST_SIZE, SEED, "is_train").filter(~F.col("is_train"))
    score = sum(F.lit(w) * F.round(F.col(c) * 100).cast("bigint") for w, c in zip(weights, features))
    return test.select("row_id", "label", score.cast("double").alias("probability"))


def train_gd(labelled: DataFrame, cfg: GDConfig, features: Sequence[str] = FRAUD_FEATURES, label: str = "label"):
    train = split_and_scale(labelled, features, label=label, columns=[*features, label]).filter("is_train")
    return fit_logistic_gd(train, features, label, cfg)


def smote_columns(train: DataFrame, features: Sequence[str], key: str = "row_id", label: str = "label",
                  ratio: float = 1.0, k: int = 5, seed: int = SEED) -> DataFrame:
    """M9 on a frame with feature columns: train rows plus ``int(ratio · n_maj − n_min)`` synthetic
    minority rows (features as columns again; synthetic keys are 'syn-<n>')."""
    from flowlens.operators.knn import smote

    arr = train.select(F.col(key).cast("string").alias(key), F.array(*features).alias("_f"), F.col(label).cast("int").alias(label))
    syn = smote(arr, key, "_f", label, k=k, ratio=ratio, seed=seed, ids=False)
    syn_rows = syn.select(F.concat(F.lit("syn-"), F.col("syn_id").cast("string")).alias(key),
                          *[F.col("_f")[i].alias(c) for i, c in enumerate(features)], F.col(label))
    out = train.select(F.col(key).cast("string").alias(key), *features, F.col(label).cast("int").alias(label)).unionByName(syn_rows)
    out.written_to = getattr(syn, "written_to", [])
    return out


def rebalancing_comparison(spark: SparkSession, labelled: DataFrame, features: Sequence[str] = FRAUD_FEATURES,
                           n_iterations: int = 50, learning_rate: float = 0.1, smote_ratio: float | None = 1.0,
                           smote_fn=None) -> DataFrame:
    """Class weights vs SMOTE vs undersampling, metrics on the test split."""
    data = split_and_scale(labelled, features, flags_only=True)
    train, test = data.filter("is_train"), data.filter(~F.col("is_train"))
    models = {}
    models["class_weight"] = LogisticRegressionGD(learning_rate, n_iterations, class_weight="balanced").fit(train, features)
    down = undersample_ratio(train, "row_id", "label", 1.0, SEED)
    models["undersample"] = LogisticRegressionGD(learning_rate, n_iterations).fit(down, features)
    if smote_fn is None and smote_ratio is not None:
        smote_fn = lambda t: smote_columns(t, features, ratio=smote_ratio)
    if smote_fn is not None:
        grown = smote_fn(train)
        models["smote"] = LogisticRegressionGD(learning_rate, n_iterations).fit(grown, features)
        if getattr(grown, "written_to", None):
            drop_written(grown)
    out = None
    for name, m in models.items():
        c = EV.confusion(m.predict(test)).withColumn("method", F.lit(name))
        out = c if out is None else out.unionByName(c)
    return out.select("method", "tp", "fp", "tn", "fn", "accuracy", "precision", "recall", "f1")
