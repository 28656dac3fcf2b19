"""Operator 5: language of a text, by sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased, every other character is a blank; n-grams of 1 to 3 characters are hashed to
``DIMENSIONS`` features. A feature's weight is its share of the text's n-grams times its inverse document
frequency, counted over all documents of the learning folds. The model is fitted to a bounded sample of
labelled rows (``PER_CLASS`` a language) with follow-the-regularised-leader steps under an elastic net,
and a temperature is fitted to a fifth of the sample that the fit didn't see. Scoring reads whole texts.

Learning uses rows whose crc32(id as text) mod 5 is not 0 and whose language is not null. A text that is
null or has no letter is ``und`` with score 0, as is every text if no row can be learnt from. Repeated
rows get equal results; a null id counts as held out; an empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import arrays as A
from flowlens.llm.common import class_sample, fold, id_and_text

DIMENSIONS = 1 << 17
PER_CLASS = 1_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-3
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """For each code point: its lower-case form if it is a letter, else a blank."""
    out = np.full(0x110000, 0x20, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a slice, letters lower-cased and all else blank, and the rows' first numbers."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    cp = data[at].astype(np.uint32)
    for low, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        big = np.flatnonzero((cp >= low) & (cp < (0xE0, 0xF0, 0xF8)[more - 1]) & (cp < 0x100))
        if len(big):
            value = data[at[big]].astype(np.uint32) & bits
            for j in range(1, more + 1):
                value = value << 6 | data[np.minimum(at[big] + j, len(data) - 1)].astype(np.uint32) & 0x3F
            cp[big] = value | 0x80000000  # marked, so that no later pass takes it for a lead byte
    cp &= 0x7FFFFFFF
    return _letters()[np.minimum(cp, 0x10FFFF)], np.searchsorted(at, offsets)


def features(cp: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: hashed features of the n-grams and the rows' first numbers."""
    h = A.mix(cp)
    for n in (1, 2, 3):
        grams, first = A.ngrams(h, starts, n)
        yield (grams >> np.uint64(64 - 17)).astype(np.int32), first


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each row's elements of a float array (elements x columns)."""
    out = np.zeros((len(first) - 1, values.shape[1]), np.float64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0, dtype=np.float64)
    return out


def sparse_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, share of the row's n-grams) of each feature that a row has."""
    cp, starts = characters(data, offsets)
    keys = np.concatenate([A.owner(first).astype(np.int64) << 17 | idx for idx, first in features(cp, starts)])
    key, n = np.unique(keys, return_counts=True)
    row = key >> 17
    total = np.bincount(row, n, minlength=len(offsets) - 1)
    return row, (key & (DIMENSIONS - 1)).astype(np.int32), (n / total[row]).astype(np.float32)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray = field(repr=False)  # features x labels, inverse document frequencies and temperature in
    bias: np.ndarray = field(repr=False)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the best label (-1: no letter, or no label) and its probability, of each row."""
        cp, starts = characters(data, offsets)
        has = row_sums((cp != 0x20)[:, None], starts)[:, 0] > 0
        if not self.labels:
            has[:] = False
        total, logits = np.zeros(len(starts) - 1), np.zeros((len(starts) - 1, max(len(self.labels), 1)))
        for idx, first in features(cp, starts) if self.labels else ():
            total += np.diff(first)
            logits += row_sums(self.weights[idx], first)
        logits = logits / np.maximum(total, 1)[:, None] + (self.bias if self.labels else 0)
        p = softmax(logits)
        best = p.argmax(axis=1)
        return np.where(has, best, -1), np.where(has, p[np.arange(len(p)), best], 0.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a multinomial model, one pass of per-coordinate FTRL steps an epoch."""
    z, n = np.zeros((DIMENSIONS + 1, k)), np.zeros((DIMENSIONS + 1, k))
    penalty = np.full(DIMENSIONS + 1, L1)
    penalty[-1] = 0.0

    def solve(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * penalty[at][:, None]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= penalty[at][:, None], 0.0, w)

    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, x = np.append(rows[i][0], DIMENSIONS), np.append(rows[i][1], 1.0)
            w = solve(at)
            p = softmax(x @ w)
            p[y[i]] -= 1.0
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = solve(np.arange(DIMENSIONS + 1))
    return w[:-1], w[-1]


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden sections on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t):
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-300)).mean()

    a, b, g = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIMENSIONS, np.int64), 0
    for part in A.slices(batches):
        _, idx, _ = sparse_rows(*A.bytes_of(part.column(1)))
        df += np.bincount(idx, minlength=DIMENSIONS)
        n += part.num_rows
    at = np.flatnonzero(df)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, DIMENSIONS).astype(np.int32)), pa.array(np.append(df[at], n))], ["feature", "n"]
        )


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in A.slices(batches):
        row, idx, share = sparse_rows(*A.bytes_of(part.column(1)))
        cut = np.searchsorted(row, np.arange(part.num_rows + 1))
        pieces = lambda a: pa.array([a[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary())
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pieces(idx), pieces(share)], ["doc_id", "lang", "at", "share"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model:
    """A model from all rows that may be learnt from; the caller leaves others out."""
    texts = id_and_text(docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()), id_col, text_col)
    counts = texts.mapInArrow(_document_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(DIMENSIONS + 1)
    df[counts.column("feature").to_numpy()] = counts.column("n").to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1.0
    rows = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("lang")
    )
    sample = class_sample(rows, "doc_id", "lang", PER_CLASS)
    got = sample.mapInArrow(_sample_rows, "doc_id long, lang string, at binary, share binary").toArrow().sort_by("doc_id")
    labels = sorted(set(got.column("lang").to_pylist()))
    if not labels:
        return Model([], np.zeros((0, 0), np.float32), np.zeros(0))
    x = [
        (np.frombuffer(a.as_py(), np.int32), np.frombuffer(s.as_py(), np.float32).astype(np.float64))
        for a, s in zip(got.column("at"), got.column("share"))
    ]
    x = [(at, share * idf[at]) for at, share in x]
    scale = 1.0 / max(np.mean([np.sqrt((v * v).sum()) for _, v in x]), 1e-9)
    x = [(at, v * scale) for at, v in x]
    y = np.array([labels.index(v) for v in got.column("lang").to_pylist()])
    held = np.arange(len(x)) % 5 == 4
    w, bias = ftrl([r for r, h in zip(x, held) if not h], y[~held], len(labels))
    logits = np.array([v @ w[at] + bias for (at, v), h in zip(x, held) if h]).reshape(-1, len(labels))
    t = temperature(logits, y[held])
    return Model(labels, (w * (idf * scale)[:, None] / t).astype(np.float32), bias / t)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.labels, UNKNOWN], dtype=object)
        for part in A.slices(batches):
            best, p = shared.value.predict(*A.bytes_of(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names[best], pa.string()), pa.array(p)], ["doc_id", "lang_pred", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(score, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learnt from the folds other than 0."""
    model = fit(docs.where(fold(id_col, folds) != 0), id_col, text_col, label_col)
    return predict(docs, model, id_col, text_col).select("doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "lang_pred", "score")
