"""Operator 4: toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word (cut at white space, A-Z lower-cased) enters as its own vector and the mean of the vectors of its
byte trigrams, word ends marked. Windows of ``LENGTH`` words, one every ``STRIDE`` words up to the end of a
text, pass a GRU forwards and backwards; attention pools the states into a logit; a text's logit is its
highest window's, made a score by a logistic scale fitted to texts that the network wasn't trained on.
Every window of every whole text is scored.

The network is trained on a bounded sample of labelled rows (``PER_CLASS`` of either label) whose
crc32(id as text) mod 3 is not 1: first on the windows with the highest log-odds words, then on those that
it finds worst itself. A word's own vector is left out at random, so that trigrams learn to speak for new
words.

Null, empty and blank texts have no window and score 0; so do all if the sample has one label only.
Repeated rows get equal scores; a null id is not held out and never learnt from. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import arrays as A
from flowlens.llm.common import class_sample, fold, id_and_text, written

LENGTH, STRIDE = 24, 12
PER_CLASS = 1_000
HIDDEN, OWN, SPELT = 8, 6, 6
SPELT_BITS = 16
LEAST_DOCS = 4
BATCH, EPOCHS, ROUNDS = 128, 4, 2
RATE, DROP = 0.05, 0.4
THRESHOLD = 0.7
_U = np.uint64


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Words:
    """The distinct words of a slice: hash of each, its trigrams' buckets, and each text word's number."""

    hashes: np.ndarray
    spelt: np.ndarray
    spelt_first: np.ndarray
    number: np.ndarray
    starts: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    first, last, h, starts = A.words(data, offsets)
    unique, where, number = np.unique(h, return_index=True, return_inverse=True)
    a, n = first[where], (last - first)[where]
    ends = np.concatenate(([0], np.cumsum(n + 2)))
    codes = np.empty(ends[-1], np.uint64)
    codes[ends[:-1]], codes[ends[1:] - 1] = 300, 301
    inner = np.ones(ends[-1], bool)
    inner[ends[:-1]] = inner[ends[1:] - 1] = False
    total = np.concatenate(([0], np.cumsum(n)))
    codes[inner] = A.LOWER[data[np.arange(total[-1]) - np.repeat(total[:-1], n) + np.repeat(a, n)]]
    grams, gram_first = A.ngrams(A.mix(codes), ends, 3)
    return Words(unique, (grams >> _U(64 - SPELT_BITS)).astype(np.int64), gram_first, number, starts)


def windows(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers of each window, -1 past a text's end; text of each window; the texts' first windows)."""
    n = np.diff(starts)
    count = np.where(n > 0, np.maximum(-(-(n - LENGTH) // STRIDE) + 1, 1), 0)
    first = np.concatenate(([0], np.cumsum(count)))
    row = A.owner(first)
    at = (starts[row] + (np.arange(first[-1]) - first[row]) * STRIDE)[:, None] + np.arange(LENGTH)
    return np.where(at < starts[row + 1][:, None], at, -1), row, first


def trigrams(w: Words, some: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of the distinct words, or of some of them, and the words' first ones."""
    if some is None:
        return w.spelt, w.spelt_first
    n = np.diff(w.spelt_first)[some]
    ends = np.concatenate(([0], np.cumsum(n)))
    return w.spelt[np.arange(ends[-1]) - np.repeat(ends[:-1], n) + np.repeat(w.spelt_first[some], n)], ends


class Network:
    """Parameters of the network, as float32 arrays by name."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 11):
        self.vocabulary = vocabulary  # ascending hashes
        rng = np.random.default_rng(seed)
        d, h = OWN + SPELT, HIDDEN
        small = lambda *shape: (rng.normal(size=shape) * 0.1).astype(np.float32)
        self.p = {"own": small(len(vocabulary) + 1, OWN), "spelt": small(1 << SPELT_BITS, SPELT), "pad": small(d)}
        self.p["own"][-1] = 0
        for side in "fb":
            self.p |= {f"W{side}": small(d, 3 * h) * 3, f"U{side}": small(h, 3 * h) * 3, f"c{side}": np.zeros(3 * h, np.float32)}
        self.p |= {"a": small(2 * h), "w": small(2 * h) * 3, "bias": np.zeros(1, np.float32)}
        self.scale = (1.0, 0.0)

    def own_rows(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each word's own vector; the last row, of zeros, for a word without one."""
        at = np.searchsorted(self.vocabulary, hashes)
        known = at < len(self.vocabulary)
        known[known] = self.vocabulary[at[known]] == hashes[known]
        return np.where(known, at, len(self.vocabulary))

    def inputs(self, w: Words, some: np.ndarray | None = None) -> np.ndarray:
        """Vectors of the distinct words (or some of them) and, last, of the place past a text's end."""
        p = self.p
        grams, first = trigrams(w, some)
        n = len(first) - 1
        spelt = np.add.reduceat(p["spelt"][grams], first[:-1], axis=0) if n else np.zeros((0, SPELT), np.float32)
        spelt /= np.maximum(np.diff(first), 1)[:, None]
        own = p["own"][self.own_rows(w.hashes if some is None else w.hashes[some])]
        return np.vstack((np.hstack((own, spelt)), p["pad"])).astype(np.float32)

    def states(self, x: np.ndarray, at: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (steps x windows x HIDDEN) over projected inputs x[at]; ``keep`` gets what backward needs."""
        u, h = self.p[f"U{side}"], HIDDEN
        s = np.zeros((at.shape[0], h), np.float32)
        out = np.empty((LENGTH, at.shape[0], h), np.float32)
        for t in range(LENGTH) if side == "f" else range(LENGTH - 1, -1, -1):
            g = x[at[:, t]]
            zr = 1 / (1 + np.exp(-(g[:, : 2 * h] + s @ u[:, : 2 * h])))
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(g[:, 2 * h :] + (r * s) @ u[:, 2 * h :])
            if keep is not None:
                keep.append((t, s, z, r, c))
            s = s + z * (c - s)
            out[t] = s
        return out

    def logits(self, inputs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Logit of each window; at holds rows of inputs (the last row past the end)."""
        out = np.empty(len(at), np.float32)
        x = {s: inputs @ self.p[f"W{s}"] + self.p[f"c{s}"] for s in "fb"}
        for k in range(0, len(at), 4096):
            a = at[k : k + 4096]
            hs = np.concatenate([self.states(x[s], a, s) for s in "fb"], axis=2)
            score = hs @ self.p["a"]
            score[(a == len(inputs) - 1).T] = -30
            e = np.exp(score - score.max(axis=0))
            pooled = np.einsum("tn,tnh->nh", e / e.sum(axis=0), hs)
            out[k : k + 4096] = pooled @ self.p["w"] + self.p["bias"]
        return out

    def text_logits(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(logit of each text, -inf without words; logits of the windows; the texts' first windows)."""
        at, _, first = windows(w.starts)
        out = np.full(len(w.starts) - 1, -np.inf)
        inputs = self.inputs(w)
        logits = self.logits(inputs, np.where(at >= 0, w.number[at] if len(w.number) else at, len(inputs) - 1))
        full = np.flatnonzero(np.diff(first))
        if len(full):
            out[full] = np.maximum.reduceat(logits, first[full])
        return out, logits, first

    def score(self, logits: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return np.where(np.isinf(logits), 0.0, sigmoid(a * np.where(np.isinf(logits), 0, logits) + b))

    def step(self, w: Words, at: np.ndarray, y: np.ndarray, rng: np.random.Generator, g2: dict[str, np.ndarray]) -> float:
        """One AdaGrad step on windows (numbers of distinct words, one too high past the end); the loss before it."""
        p, h, d = self.p, HIDDEN, OWN + SPELT
        used, at = np.unique(np.append(at.ravel(), len(w.hashes)), return_inverse=True)
        at, used = at[:-1].reshape(-1, LENGTH), used[:-1]
        inputs = self.inputs(w, used)
        drop = rng.random(len(inputs)) < DROP
        inputs[drop, :OWN] = 0
        pad = np.arange(len(inputs)) == len(used)
        keep = {"f": [], "b": []}
        x = {s: inputs @ p[f"W{s}"] + p[f"c{s}"] for s in "fb"}
        hs = np.concatenate([self.states(x[s], at, s, keep[s]) for s in "fb"], axis=2)
        score = hs @ p["a"]
        score[pad[at].T] = -30
        e = np.exp(score - score.max(axis=0))
        share = e / e.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, hs)
        prob = sigmoid(pooled @ p["w"] + p["bias"])
        off = ((prob - y) / len(y)).astype(np.float32)
        grad = {"w": pooled.T @ off, "bias": off.sum(keepdims=True)}
        d_pooled = off[:, None] * p["w"]
        d_share = np.einsum("tnh,nh->tn", hs, d_pooled)
        d_score = share * (d_share - (share * d_share).sum(axis=0))
        grad["a"] = np.einsum("tn,tnh->h", d_score, hs)
        d_hs = share[:, :, None] * d_pooled + d_score[:, :, None] * p["a"]
        d_inputs = np.zeros((len(inputs), d), np.float32)
        for k, s in enumerate("fb"):
            u, d_x = p[f"U{s}"], np.zeros((len(inputs), 3 * h), np.float32)
            d_u, carry = np.zeros_like(u), np.zeros((len(y), h), np.float32)
            for t, before, z, r, c in reversed(keep[s]):
                ds = carry + d_hs[t, :, k * h : (k + 1) * h]
                dc = ds * z * (1 - c * c)
                dz = ds * (c - before) * z * (1 - z)
                drs = dc @ u[:, 2 * h :].T
                dr = drs * before * r * (1 - r)
                gates = np.hstack((dz, dr))
                carry = ds * (1 - z) + drs * r + gates @ u[:, : 2 * h].T
                d_u[:, : 2 * h] += before.T @ gates
                d_u[:, 2 * h :] += (r * before).T @ dc
                np.add.at(d_x, at[:, t], np.hstack((gates, dc)))
            grad |= {f"U{s}": d_u, f"W{s}": inputs.T @ d_x, f"c{s}": d_x.sum(axis=0)}
            d_inputs += d_x @ p[f"W{s}"].T
        for name, g in grad.items():
            g2[name] += g * g
            p[name] -= RATE * g / np.sqrt(g2[name])
        g2["pad"] += d_inputs[-1] ** 2
        p["pad"] -= RATE * d_inputs[-1] / np.sqrt(g2["pad"])
        own = self.own_rows(w.hashes[used])
        learn = (own < len(self.vocabulary)) & ~drop[:-1]
        self._sparse("own", own[learn], d_inputs[:-1][learn, :OWN], g2)
        grams, first = trigrams(w, used)
        n = np.diff(first)
        self._sparse("spelt", grams, np.repeat(d_inputs[:-1, OWN:] / np.maximum(n, 1)[:, None], n, axis=0), g2)
        return float(-np.log(np.maximum(np.where(y > 0, prob, 1 - prob), 1e-9)).mean())

    def _sparse(self, name: str, rows: np.ndarray, grad: np.ndarray, g2: dict[str, np.ndarray]) -> None:
        unique, back = np.unique(rows, return_inverse=True)
        g = np.zeros((len(unique), grad.shape[1]), np.float32)
        np.add.at(g, back, grad)
        g2[name][unique] += g * g
        self.p[name][unique] -= 2 * RATE * g / np.sqrt(g2[name][unique])


def log_odds(buckets: np.ndarray, docs: np.ndarray, toxic: np.ndarray, size: int) -> np.ndarray:
    """Log odds that a document with a bucket is toxic, against all documents; 0 where hardly seen."""
    seen = np.unique(docs * size + buckets)
    doc, bucket = seen // size, seen % size
    n = [np.bincount(bucket[toxic[doc] == k], minlength=size) for k in (0, 1)]
    total = [(toxic == k).sum() for k in (0, 1)]
    odds = np.log((n[1] + 0.5) / (total[1] + 1)) - np.log((n[0] + 0.5) / (total[0] + 1))
    return np.where(n[0] + n[1] >= LEAST_DOCS, np.clip(odds, -4, 4), 0.0)


def train(texts: pa.Array, toxic: np.ndarray, seed: int = 4) -> Network | None:
    """A network from texts and their labels; None if there is one label only. Every fifth text sets the scale."""
    if len(set(toxic.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    w = words_of(*A.bytes_of(texts))
    at, row, first = windows(w.starts)
    n = len(w.hashes)
    number = np.where(at >= 0, w.number[at] if len(w.number) else at, n)
    fit = np.arange(len(toxic)) % 5 != 4
    doc = A.owner(w.starts)
    once = np.unique(doc[fit[doc]] * n + w.number[fit[doc]])
    word, of = once % n, once // n
    frequent = np.bincount(word, minlength=n) >= LEAST_DOCS
    net = Network(w.hashes[frequent])
    net.p["own"][:-1, 0] = log_odds(word, of, toxic, n)[frequent] / 2
    grams, ends = trigrams(w, word)
    net.p["spelt"][:, 0] = log_odds(grams, np.repeat(of, np.diff(ends)), toxic, 1 << SPELT_BITS) / 2
    guess = np.append(net.inputs(w)[:-1, [0, OWN]].sum(axis=1), -9.0)[number].max(axis=1, initial=-9.0)
    g2 = {k: np.full_like(v, 1e-3 if v.ndim == 1 or k[0] in "WU" else 1e-4) for k, v in net.p.items()}
    picked: list[np.ndarray] = []
    for turn in range(ROUNDS + 1):
        order = np.lexsort((-guess, row))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order)) - first[row[order]]
        good = (toxic[row] == 1) & (place < (2 if turn == 0 else 1))
        bad = (toxic[row] == 0) & ((place < 2) | (rng.random(len(row)) < 0.02))
        picked.append(np.flatnonzero((good | bad) & fit[row]))
        chosen = np.unique(np.concatenate(picked))
        for _ in range(EPOCHS):
            mixed = rng.permutation(chosen)
            for k in range(0, len(mixed), BATCH):
                some = mixed[k : k + BATCH]
                net.step(w, number[some], toxic[row[some]].astype(np.float32), rng, g2)
        logits, guess, _ = net.text_logits(w)
    held = ~fit & np.isfinite(logits)
    net.scale = logistic(logits[held], toxic[held])
    return net


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of y on x by Newton steps, held back a little so that separable data stay finite."""
    a, b = 1.0, 0.0
    for _ in range(50 if len(x) else 0):
        p = sigmoid(a * x + b)
        v = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - y) * x).sum() + 0.1 * (a - 1), (p - y).sum() + 0.1 * b])
        hess = np.array([[(v * x * x).sum() + 0.1, (v * x).sum()], [(v * x).sum(), v.sum() + 0.1]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(hess, g), -1, 1)
    return float(max(a, 0.05)), float(b)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3) -> Network | None:
    """The network from labels (doc_id, toxic) of rows in folds other than 1."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold("doc_id", folds) != 1)).dropDuplicates(["doc_id"])
    ids = written(class_sample(rows, "doc_id", "toxic", PER_CLASS), "toxic-sample")
    sample = id_and_text(docs).join(F.broadcast(ids), "doc_id").where("text is not null").toArrow().sort_by("doc_id")
    return train(sample.column("text").combine_chunks(), sample.column("toxic").to_numpy())


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    net = fit(docs, labels, folds)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in A.slices(batches, limit=2 * A.SLICE_BYTES):
            data, offsets = A.bytes_of(part.column(1))
            known = shared.value
            p = known.score(known.text_logits(words_of(data, offsets))[0]) if known else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p.astype(np.float64))], ["doc_id", "score"])

    scored = id_and_text(docs).mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id", (fold("doc_id", folds) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
