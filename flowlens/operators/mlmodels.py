"""Models (T9-T12): the library's logistic regression and one-vs-rest linear SVM, the decision tree of ``tree``
and its node table. Features arrive as an ``array<double>`` or as columns and are turned into an ML vector
JVM-side (``array_to_vector`` / ``VectorAssembler``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.tree import TreeModel, fit_tree


def as_vector(df: DataFrame, features: str | Sequence[str], out: str = "fv") -> DataFrame:
    if isinstance(features, str):
        return df.withColumn(out, array_to_vector(F.col(features)))
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def mllib_logistic(train: DataFrame, features: str | Sequence[str], label: str = "label", max_iter: int = 100,
                   reg: float = 0.0):
    """Library logistic regression with intercept."""
    lr = LogisticRegression(featuresCol="fv", labelCol=label, maxIter=max_iter, regParam=reg, fitIntercept=True)
    return lr.fit(as_vector(train, features).withColumn(label, F.col(label).cast("double")))


def ovr_linear_svc(train: DataFrame, features: str | Sequence[str], label: str = "label", max_iter: int = 100,
                   parallelism: int = 4):
    """Multi-class linear SVM as one-vs-rest."""
    ovr = OneVsRest(classifier=LinearSVC(maxIter=max_iter), featuresCol="fv", labelCol=label, parallelism=parallelism)
    return ovr.fit(as_vector(train, features).withColumn(label, F.col(label).cast("double")))


def decision_tree(train: DataFrame, features: str | Sequence[str], label: str = "label", max_depth: int = 30,
                  max_bins: int = 150, seed: int = 42):
    """Gini decision tree grown to ``max_depth`` (30 is the deepest that the library grows), the library's tree by jobs
    that grow with the rows (``tree``)."""
    return fit_tree(train, features, label, max_depth, max_bins, seed)


def accuracy(model, test: DataFrame, features: str | Sequence[str], label: str = "label") -> DataFrame:
    if isinstance(model, TreeModel):
        pred = model.predict(test, features, label).withColumnRenamed("label", label)
    else:
        pred = model.transform(as_vector(test, features).withColumn(label, F.col(label).cast("double")))
    return pred.agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def tree_nodes(model: TreeModel, path: str) -> DataFrame:
    """Node table (id, prediction, impurity, split feature/threshold, children, counts) of a
    fitted tree, saved in the shared ``path`` and read back."""
    nodes = model.nodes()
    nodes.write.mode("overwrite").parquet(f"{path}/data")
    return nodes.sparkSession.read.schema(nodes.schema).parquet(f"{path}/data")


def tree_dot(nodes: DataFrame, feature_names: Sequence[str] | None = None, name: str = "DecisionTree") -> DataFrame:
    """T12 → S10: the node table as DOT lines (split or class, impurity, samples per node; edges to
    both children). Node tables are bounded by 2^(maxDepth+1) rows."""
    from flowlens.sources.sinks import dot_lines

    spark = nodes.sparkSession
    feat = F.concat(F.lit("x["), F.col("feature_index").cast("string"), F.lit("]"))
    if feature_names:
        names = spark.createDataFrame(list(enumerate(feature_names)), "feature_index int, fname string")
        nodes = nodes.join(F.broadcast(names), "feature_index", "left")
        feat = F.coalesce(F.col("fname"), feat)
    is_leaf = F.col("leftChild") < 0
    label = F.concat_ws(
        "\\n",
        F.when(~is_leaf, F.concat(feat, F.lit(" <= "), F.format_number("threshold", 2))),
        F.concat(F.lit("gini = "), F.format_number("impurity", 3)),
        F.concat(F.lit("samples = "), F.col("samples").cast("bigint").cast("string")),
        F.concat(F.lit("class = "), F.col("prediction").cast("int").cast("string")),
    )
    node_rows = nodes.select(F.col("id").cast("string").alias("id"), label.alias("label"))
    inner = nodes.filter(~is_leaf)
    edges = inner.select(F.col("id").cast("string").alias("src"), F.col("leftChild").cast("string").alias("dst"),
                         F.lit("True").alias("label")).unionByName(
        inner.select(F.col("id").cast("string").alias("src"), F.col("rightChild").cast("string").alias("dst"),
                     F.lit("False").alias("label")))
    return dot_lines(name, node_rows, edges)
