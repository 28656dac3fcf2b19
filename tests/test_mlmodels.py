"""T9-T12 wrappers on the driver's embeddings (multi-class) and the tree → DOT export."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.operators import mlmodels as ML
from flowlens.operators import tree as TR
from flowlens.session import ensure_checkpoint_dir
from flowlens.sources import adapters as A
from tests.conftest import SF_SMALL, rows


def test_tree_nodes_and_dot(spark):
    e = A.embedding_view(spark, SF_SMALL, binary=False)
    m = ML.decision_tree(e, "features", max_depth=3)
    nodes = ML.tree_nodes(m, ensure_checkpoint_dir(spark).rstrip("/") + "/tree-test")
    rows = nodes.collect()
    assert len(rows) == m.numNodes
    inner = [r for r in rows if r.leftChild >= 0]
    assert all(r.threshold is not None for r in inner)
    lines = [r.line for r in ML.tree_dot(nodes).orderBy("seq", "key").collect()]
    assert lines[0].startswith('digraph "DecisionTree"') and lines[-1] == "}"
    assert sum(" -> " in ln for ln in lines) == 2 * len(inner)


def test_library_models_score(spark):
    e = A.embedding_view(spark, SF_SMALL, binary=True)
    lr = ML.mllib_logistic(e, "features", max_iter=10)
    acc = ML.accuracy(lr, e, "features").first()
    assert 0.0 <= acc.accuracy <= 1.0 and acc.n == e.count()


def _library_nodes(spark, df, path, **params):
    from pyspark.ml.classification import DecisionTreeClassifier

    dt = DecisionTreeClassifier(featuresCol="fv", labelCol="label", impurity="gini", seed=42, **params)
    lib = dt.fit(ML.as_vector(df, "features").withColumn("label", F.col("label").cast("double")))
    lib.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    return lib, rows(nodes.select(
        "id", "prediction", "impurity", "gain", "leftChild", "rightChild", "split.featureIndex",
        F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)), F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b),
    ))


@pytest.mark.parametrize("group_rows", [40, 4096])
def test_tree_is_the_librarys_tree(spark, monkeypatch, group_rows):
    """Ids, splits, impurities and counts; ties of equal gain, copies of rows with other labels, fewer bins than values."""
    monkeypatch.setattr(TR, "GROUP_ROWS", group_rows)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 4)), 1)
    x[:, 3] = x[:, 0]
    x[300:] = x[:100]
    df = spark.createDataFrame([(v.tolist(), int(y)) for v, y in zip(x, rng.integers(0, 4, 400))], "features array<double>, label int").cache()
    base = ensure_checkpoint_dir(spark).rstrip("/")
    lib, want = _library_nodes(spark, df, f"{base}/tree-lib-{group_rows}", maxDepth=30, maxBins=20)
    m = ML.decision_tree(df, "features", max_bins=20)
    assert (len(m.top) > 0) == (group_rows < 400)
    assert rows(ML.tree_nodes(m, f"{base}/tree-own-{group_rows}")) == want
    assert ML.accuracy(m, df, "features").first() == ML.accuracy(lib, df, "features").first()


def test_tree_of_one_class_and_bad_rows(spark):
    one = spark.createDataFrame([([float(i)], 1) for i in range(5)], "features array<double>, label int")
    m = ML.decision_tree(one, "features")
    lib, want = _library_nodes(spark, one, ensure_checkpoint_dir(spark).rstrip("/") + "/tree-one", maxDepth=30, maxBins=150)
    assert rows(ML.tree_nodes(m, ensure_checkpoint_dir(spark).rstrip("/") + "/tree-one-own")) == want
    for bad in (([1.0], None), (None, 1), ([float("nan")], 1), ([1.0], -1)):
        with pytest.raises(Exception):
            ML.decision_tree(one.unionByName(spark.createDataFrame([bad], "features array<double>, label int")), "features")


def test_deep_tree_takes_no_job_a_level(spark):
    """The library runs jobs for each level and each few hundred nodes, with a table of all cells for every node."""
    df = spark.createDataFrame([([float(i)], (i % 3 + i % 7) % 2) for i in range(150)], "features array<double>, label int").cache()
    spark.sparkContext.setJobGroup("one tree", "")
    m = ML.decision_tree(df, "features")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("one tree"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert m.numNodes > 60
    assert jobs < 20
