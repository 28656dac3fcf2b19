"""Operator 3: document rates that mix soft domains to target weights.

A classifier learnt from all rows of a labelled table gives each document a probability
for each domain: softmax regression on hashed words, their pairs' repetition and the kinds of characters, fitted
by the ML library, a pass over the labelled documents' features a step.
A document of n words with probabilities p adds n * p to the domains' expected words. Non-negative rates r
are fitted by projected gradient steps to the least squares of (sum r n p - target), measured in the
metric of the second moments of the domains' words over documents with a rate above 0, in which the step
length is 1. Rates start at 1, so documents keep the rate 1 as far as the targets allow. The classifier is
fitted to equal weights of the domains; its bias is then set to the domains' shares of all labelled rows.

A step changes a rate by -n p . z for a vector z with one number a domain, so a rate is worked out from the
list of all z so far, and a step is one aggregate over a narrow table (words and probabilities): nothing a
document has travels, and the driver holds a few numbers a step.

Null, empty and blank texts have 0 words, rate 1 and add nothing; they get the classifier's probabilities
of an empty text. Repeated rows count each; a null id is carried. Without labelled rows, or with one
domain, all probabilities are equal, or 1. An empty table gives an empty result. Targets that no
non-negative rates reach are approached as far as ``STEPS`` steps go.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm import arrays as A
from flowlens.llm.common import BROADCAST_ROWS, id_and_text, package_reachable, written

#: Share of all words that each domain is to have after mixing; a domain not named keeps none.
TARGETS = {"clean": 0.9, "junk": 0.07, "toxic": 0.03}
BUCKETS = 1 << 16
KINDS = 6
PASSES, PENALTY = 50, 1e-5
STEPS, CLOSE = 25, 1e-4


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray = field(repr=False)  # (word buckets + character kinds) x domains
    bias: np.ndarray = field(repr=False)

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of words and domain probabilities of each row."""
        bucket, starts, kinds = parts(data, offsets)
        sums = np.zeros((len(offsets) - 1, len(self.domains)))
        full = np.flatnonzero(np.diff(starts))
        if len(full):
            sums[full] = np.add.reduceat(self.weights[bucket], starts[full], axis=0, dtype=np.float64)
        n = np.diff(starts)
        return n, softmax(sums / np.sqrt(np.maximum(n, 1))[:, None] + kinds @ self.weights[BUCKETS:] + self.bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


_KIND = np.full(256, 3)
_KIND[[*range(97, 123), *range(128, 256)]] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[A.WHITE] = 4


def parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, the rows' first words, and each row's shares of kinds of characters and of repeated words."""
    first, last, h, starts = A.words(data, offsets)
    row = A.owner(offsets)
    size = np.maximum(np.diff(offsets), 1)
    kinds = np.bincount(row * 5 + _KIND[data], minlength=5 * len(size)).reshape(-1, 5) / size[:, None]
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[starts[:-1][np.diff(starts) > 0]] = False
    repeats = np.bincount(A.owner(starts), again, len(size)) / np.maximum(np.diff(starts), 1)
    return (h >> np.uint64(48)).astype(np.int64), starts, 10 * np.column_stack((kinds, repeats))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in A.slices(batches):
        bucket, starts, kinds = parts(*A.bytes_of(part.column(1)))
        at, value = [], []
        for a, b, k in zip(starts[:-1], starts[1:], kinds):
            unique, n = np.unique(bucket[a:b], return_counts=True)
            at.append(np.append(unique, BUCKETS + np.arange(KINDS)).astype(np.int32))
            value.append(np.append(n / np.sqrt(max(b - a, 1)), k))
        yield pa.RecordBatch.from_arrays([part.column(2), pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64()))], ["domain", "at", "value"])


def fit_classifier(docs: DataFrame, labelled: DataFrame) -> Classifier:
    """Softmax regression from the texts of all documents (doc_id, text) that ``labelled`` (doc_id, domain) names."""
    rows = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("domain").cast("string").alias("domain"))
    ids = written(rows.where("doc_id is not null").dropDuplicates(["doc_id"]).where("domain is not null"), "mix-labels")
    few = ids.count() <= BROADCAST_ROWS
    labels = id_and_text(docs).join(F.broadcast(ids) if few else ids, "doc_id").select("doc_id", "text", "domain")
    found = written(labels.mapInArrow(_features, "domain string, at array<int>, value array<double>"), "mix-features")
    sizes = {r["domain"]: r["n"] for r in found.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    domains = sorted(sizes) or ["all"]
    weights, bias = np.zeros((BUCKETS + KINDS, len(domains))), np.zeros(len(domains))
    if len(domains) > 1:
        vector = F.udf(lambda at, value: Vectors.sparse(BUCKETS + KINDS, at, value), VectorUDT())
        number, share = F.lit(None).cast("double"), F.lit(None).cast("double")
        for i, d in enumerate(domains):
            number = F.when(F.col("domain") == d, float(i)).otherwise(number)
            share = F.when(F.col("domain") == d, sum(sizes.values()) / (len(domains) * sizes[d])).otherwise(share)
        train = found.select(vector("at", "value").alias("features"), number.alias("label"), share.alias("weight"))
        lr = LogisticRegression(weightCol="weight", family="multinomial", maxIter=PASSES, regParam=PENALTY, standardization=False)
        model = lr.fit(train)
        weights, bias = model.coefficientMatrix.toArray().T, model.interceptVector.toArray()
    counts = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = np.log([counts.get(d, 1) for d in domains])
    return Classifier(domains, weights.astype(np.float32), bias + prior - prior.max())


def memberships(docs: DataFrame, classifier: Classifier, text_col: str = "text", words: str = "n_tokens", share: str = "posterior") -> DataFrame:
    """docs with two more columns: number of words and the array of domain probabilities. Their names must be new."""
    shared = package_reachable(docs.sparkSession).sparkContext.broadcast(classifier)
    schema = docs.select("*", F.lit(0).cast("long").alias(words), F.array(F.lit(0.0)).alias(share)).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in A.slices(batches, text_col, A.SLICE_BYTES // 2):
            n, p = shared.value.probabilities(*A.bytes_of(part.column(part.schema.get_field_index(text_col))))
            each = pa.ListArray.from_arrays(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32), p.ravel())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n.astype(np.int64)), each], [*part.schema.names, words, share])

    return docs.mapInArrow(score, schema)


def rate(steps: list[np.ndarray], scale: float, words: str = "n_tokens", share: str = "posterior") -> Column:
    """The rate after the steps; a step takes share . z * words / scale off and stops at 0."""
    out = F.lit(1.0)
    if not steps:
        return out
    moves = F.array(*[F.array(*[F.lit(float(v)) for v in z]) for z in steps])
    weight = F.col(words) / F.lit(scale)
    dot = lambda z: F.aggregate(F.zip_with(F.col(share), z, lambda p, v: p * v), F.lit(0.0), lambda a, b: a + b)
    return F.aggregate(moves, out, lambda r, z: F.greatest(F.lit(0.0), r - weight * dot(z)))


def fit_rates(members: DataFrame, target: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Steps for ``rate`` from (n_tokens, posterior) of all documents; target: share of all words by domain."""
    k = len(target)
    p = lambda i: F.col("posterior")[i]
    total = members.agg(F.sum("n_tokens")).first()[0] or 0
    if not total:
        return [], 1.0
    part = F.col("n_tokens") / F.lit(float(total))
    sums = [F.sum(F.col("part") * F.col("r") * p(i)) for i in range(k)]
    sums += [F.sum(F.when(F.col("r") > 0, F.col("part") * p(i) * F.col("part") * p(j))) for i in range(k) for j in range(i + 1)]
    steps: list[np.ndarray] = []
    for _ in range(STEPS):
        rated = members.select(part.alias("part"), "posterior", rate(steps, float(total)).alias("r"))
        got = np.array([v or 0.0 for v in rated.agg(*sums).first()])
        off = got[:k] - target
        if np.abs(off).max() < CLOSE:
            break
        moments = np.zeros((k, k))
        moments[np.tril_indices(k)] = got[k:]
        moments += np.tril(moments, -1).T
        steps.append(np.linalg.pinv(moments + np.eye(k) * max(np.trace(moments), 1e-300) * 1e-9) @ off)
    return steps, float(total)


def domains_of(labels: DataFrame) -> DataFrame:
    """doc_id, domain of the label table: toxic, else junk (quality 0), else clean (quality 1)."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """doc_id, n_tokens, a probability p_<domain> for each domain, and rate of every row."""
    texts = id_and_text(docs)
    classifier = fit_classifier(texts, domains_of(labels))
    members = written(memberships(texts, classifier).select("doc_id", "n_tokens", "posterior"), "members")
    goal = np.array([targets.get(d, 0.0) for d in classifier.domains])
    goal = goal / goal.sum() if goal.sum() else np.full(len(goal), 1 / len(goal))
    steps, scale = fit_rates(members, goal)
    each = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(classifier.domains)]
    return members.select("doc_id", "n_tokens", *each, rate(steps, scale).alias("rate"))


def with_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """docs with the rate as column ``mix_rate`` (in place of one of that name), without rows of rate 0."""
    texts = id_and_text(docs)
    classifier = fit_classifier(texts, domains_of(labels))
    members = written(memberships(texts, classifier).select("n_tokens", "posterior"), "members")
    goal = np.array([targets.get(d, 0.0) for d in classifier.domains])
    goal = goal / goal.sum() if goal.sum() else np.full(len(goal), 1 / len(goal))
    steps, scale = fit_rates(members, goal)
    words, share = "_mix_words", "_mix_posterior"
    out = memberships(docs.drop("mix_rate"), classifier, "text", words, share)
    return out.withColumn("mix_rate", rate(steps, scale, words, share)).drop(words, share).where("mix_rate > 0")
