"""Operator 2: cross-entropy difference of a target and a background bigram model.

The background model is counted over all documents, the target model over all trusted ones: a join with the trusted
ids marks their rows (by broadcast while there are at most ``BROADCAST_ROWS``, else by a shuffle). Both are bigram models of one shared vocabulary (the
``VOCABULARY`` most frequent words of all documents; any other word is one unknown word; a mark stands
before the first word), of the same order and smoothing: p(w | v) = (c(v w) + MU p(w)) / (c(v) + MU) with
add-one unigrams. The bigram counts c that score a document leave out its own, in either model that it was
counted in. A document's score is its mean loss a word under the target less that under the background: the
lower, the more like trusted text.

Words are numbered by frequency, so a pair of numbers names a bigram exactly. Map tasks reduce a chunk of
text to its distinct bigrams and deal them, packed, to shards by a hash of the pair; a shard adds up the
counts. Then the chunks send each shard the bigrams of their documents, get the documents' summed losses
back and add them up: no text is shuffled. Bigrams of two of the ``FREQUENT`` most frequent words, which
could flood a shard, are scored in the map task from a broadcast table of at most FREQUENT**2 counts; any
other bigram has a word that makes up at most 1 / FREQUENT of all words. The number of shards follows the
number of words.

Null, empty and blank texts have 0 words, null losses and a null score. Repeated rows are scored, and
counted in the background, each; a null id is never a target. Without trusted rows the target model is the
uniform one. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import arrays as A
from flowlens.llm.common import id_and_text, marked, package_reachable, written

VOCABULARY = 1 << 16
FREQUENT = 1024
MU = 50.0
SHARD_WORDS = 2_000_000
CHUNK_BYTES = 8 << 20
_UNKNOWN, _FIRST = 0, 1
_U = np.uint64


@dataclass
class Unigrams:
    """Shared vocabulary: sorted word hashes, their numbers, and counts by number (background, target)."""

    hashes: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray

    def number(self, h: np.ndarray) -> np.ndarray:
        unique, back = np.unique(h, return_inverse=True)
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, unique), len(self.hashes) - 1)
        return np.where(self.hashes[at] == unique, self.numbers[at], _UNKNOWN)[back]

    def losses(self, pairs: np.ndarray, counts: np.ndarray, own: np.ndarray, own_first: np.ndarray) -> np.ndarray:
        """Losses in bits of occurrences of bigrams, columns background and target.

        counts are those of the bigram; own and own_first what of them, and of its first word's, is to be left out.
        """
        total = self.counts.sum(axis=0) + len(self.counts)
        p = (self.counts[pairs & 0x1FFFF] + 1.0) / total
        return -np.log2((counts - own + MU * p) / (self.counts[pairs >> 17] - own_first + MU))


def _texts(batches: Iterator[pa.RecordBatch]):
    for part in A.slices(batches, limit=CHUNK_BYTES):
        _, _, h, starts = A.words(*A.bytes_of(part.column(1)))
        yield part, h, starts, part.column(2).to_numpy(zero_copy_only=False)


def _bigrams(numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[starts[:-1][np.diff(starts) > 0]] = _FIRST
    return before << 17 | numbers


def _shard(pairs: np.ndarray, shards: int) -> np.ndarray:
    return ((A.mix(pairs) >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)


def _pack(pairs: np.ndarray) -> bytes:
    """Bigrams (34 bits), 5 bytes each."""
    return pairs.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<i8").ravel()


def _sum_by(keys: np.ndarray, *weights: np.ndarray):
    unique, back = np.unique(keys, return_inverse=True)
    return unique, *(np.bincount(back, w, len(unique)).astype(np.int64) for w in weights)


def unigrams(texts: DataFrame) -> tuple[Unigrams, int]:
    """The shared vocabulary with its counts, and the number of words of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged():
            key, n, t = _sum_by(*(np.concatenate(c) for c in zip(*held)))
            held[:] = [(key, n, t)]

        docs = [0, 0]
        for _, h, starts, target in _texts(batches):
            held.append(_sum_by(h, np.ones(len(h)), np.repeat(target, np.diff(starts)).astype(float)))
            full = np.diff(starts) > 0
            docs = [docs[0] + int(full.sum()), docs[1] + int((full & target).sum())]
            if len(held) >= 4:
                merged()
            if len(held[0][0]) > 2_000_000:  # a bounded store: what it holds goes on, later rows add up in the shuffle
                yield _rows(*held.pop(0))
        if held:
            merged()
            yield _rows(*held[0])
        if docs[0]:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array(docs[:1]), pa.array(docs[1:])], ["word", "n", "t"])

    def _rows(key, n, t):
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n), pa.array(t)], ["word", "n", "t"])

    counts = written(texts.mapInArrow(count, "word long, n long, t long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "words")
    known = counts.where("word is not null")
    top = known.orderBy(F.desc("n"), "word").limit(VOCABULARY).toArrow()
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    docs = counts.where("word is null").first()
    by = np.stack([top.column("n").to_numpy(), top.column("t").to_numpy()], axis=1).reshape(-1, 2).astype(np.float64)
    rest = np.array([total[0], total[1]], np.float64) - by.sum(axis=0)
    first = np.array([docs["n"], docs["t"]], np.float64) if docs else np.zeros(2)
    h = top.column("word").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return Unigrams(h[order], (np.arange(len(h)) + 2)[order], np.concatenate(([rest, first], by))), int(total[0])


def _count_chunks(vocabulary, shards: int):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, starts, target in _texts(batches):
            if not len(h):
                continue
            pairs = _bigrams(vocabulary.value.number(h), starts)
            key, n, t = _sum_by(pairs, np.ones(len(pairs)), np.repeat(target, np.diff(starts)).astype(float))
            yield from _dealt(key, _shard(key, shards), shards, n.astype("<i4"), t.astype("<i4"))

    return chunks


def _dealt(key, shard, shards, *arrays) -> Iterator[pa.RecordBatch]:
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    full = np.flatnonzero(np.diff(cut))
    if len(full):
        pieces = [[_pack(key[order[cut[s] : cut[s + 1]]]) for s in full]]
        pieces += [[a[order[cut[s] : cut[s + 1]]].tobytes() for s in full] for a in arrays]
        names = ["keys", "n", "t"]
        yield pa.RecordBatch.from_arrays([pa.array(full), *(pa.array(p, pa.binary()) for p in pieces)], ["shard", *names[: len(pieces)]])


def _shard_counts(rows: pd.DataFrame) -> pd.DataFrame:
    key = np.concatenate([_unpack(k) for k in rows["keys"]])
    key, n, t = _sum_by(key, *(np.concatenate([np.frombuffer(x, "<i4") for x in rows[c]]) for c in ("n", "t")))
    common = (key >> 17 < FREQUENT) & (key & 0x1FFFF < FREQUENT)
    packed = lambda at: [[_pack(key[at])], [n[at].astype("<i8").tobytes()], [t[at].astype("<i8").tobytes()]]
    columns = [rows["shard"].iloc[:1].to_list(), *packed(~common), *packed(common)]
    return pd.DataFrame(dict(zip(("shard", "keys", "n", "t", "f_keys", "f_n", "f_t"), columns)))


def _own(pairs: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each occurrence's document has its first word, and its bigram, before a word."""
    out = []
    for key in (pairs >> 17, pairs):
        _, back, n = np.unique(doc << 34 | key, return_inverse=True, return_counts=True)
        out.append(n[back])
    return out[0], out[1]


def _document_chunks(vocabulary, frequent, shards: int):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for part in A.slices(batches, limit=CHUNK_BYTES):
            for at in range(0, part.num_rows, 60_000):
                for rows, h, starts, target in _texts([part.slice(at, 60_000)]):
                    number += 1
                    yield from chunk_rows(TaskContext.get().partitionId() << 32 | number, rows, h, starts, target)

    def chunk_rows(chunk, rows, h, starts, target):
        pairs, doc = _bigrams(vocabulary.value.number(h), starts), A.owner(starts)
        own_first, own = _own(pairs, doc)
        common = (pairs >> 17 < FREQUENT) & (pairs & 0x1FFFF < FREQUENT)
        p, d = pairs[common], doc[common]
        share = np.stack([np.ones(len(d)), target[d]], 1)
        bits = vocabulary.value.losses(p, frequent.value[p >> 17, p & 0x1FFFF], own[common][:, None] * share, own_first[common][:, None] * share)
        sums = np.stack([np.bincount(d, bits[:, k], rows.num_rows) for k in (0, 1)]).astype("<f8")
        ids = rows.column(0)
        flags = lambda x: np.packbits(x).tobytes()
        yield _batch(
            -1 - chunk % shards, [chunk], [rows.num_rows], [b""], [ids.fill_null(0).to_numpy().astype("<i8").tobytes()],
            [np.diff(starts).astype("<i8").tobytes()], [sums.tobytes()], [flags(ids.is_valid().to_numpy(zero_copy_only=False))],
        )
        pairs, doc, own_first = pairs[~common], doc[~common], own_first[~common]
        shard = _shard(pairs, shards)
        order = np.lexsort((pairs, shard))
        pairs, doc, own_first = pairs[order], doc[order], own_first[order]
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        full = np.flatnonzero(np.diff(cut))
        keys, runs, docs, firsts = [], [], [], []
        for s in full:
            here = slice(cut[s], cut[s + 1])
            p = pairs[here]
            heads = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
            keys.append(_pack(p[heads]))
            runs.append(np.diff(np.append(heads, len(p))).astype("<u4").tobytes())
            docs.append(doc[here].astype("<u2").tobytes())
            firsts.append(own_first[here].astype("<u4").tobytes())
        n = len(full)
        yield _batch(full, [chunk] * n, [rows.num_rows] * n, keys, docs, runs, firsts, [flags(target)] * n)

    return chunks


#: A chunk's row for a shard: bigrams, their runs, and by occurrence the document and how often it has the first
#: word; flags of target documents. A chunk's own row (negative shard): ids, words, summed losses; flags of ids.
_CHUNK_SCHEMA = "shard long, chunk long, rows long, keys binary, docs binary, runs binary, sums binary, flags binary"


def _batch(shard, chunk, rows, *binary) -> pa.RecordBatch:
    shard = pa.array(np.atleast_1d(np.asarray(shard, np.int64)))
    names = [f.split()[0] for f in _CHUNK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([shard, pa.array(chunk, pa.int64()), pa.array(rows, pa.int64()), *(pa.array(b, pa.binary()) for b in binary)], names)


def _answer(vocabulary):
    """Each chunk's summed losses of its documents' bigrams of one shard; a chunk's own row passes through."""

    def answer(chunks: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(model):
            known = _unpack(model["keys"].iloc[0])
            counts = np.stack([np.frombuffer(model[c].iloc[0], "<i8") for c in ("n", "t")], 1)
        for r in chunks.itertuples():
            if r.shard < 0:
                out.append((r.chunk, r.rows, r.docs, r.runs, r.sums, r.flags))
                continue
            run, doc = np.frombuffer(r.runs, "<u4"), np.frombuffer(r.docs, "<u2").astype(np.int64)
            pairs = np.repeat(_unpack(r.keys), run)
            at = np.repeat(np.searchsorted(known, _unpack(r.keys)), run)
            new = np.concatenate(([True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])))
            heads = np.flatnonzero(new)
            own = np.diff(np.append(heads, len(doc)))[np.cumsum(new) - 1]
            target = np.unpackbits(np.frombuffer(r.flags, np.uint8))[: r.rows]
            share = np.stack([np.ones(len(doc)), target[doc]], 1)
            bits = vocabulary.value.losses(pairs, counts[at], own[:, None] * share, np.frombuffer(r.sums, "<u4")[:, None] * share)
            sums = np.stack([np.bincount(doc, bits[:, k], r.rows) for k in (0, 1)]).astype("<f4")
            out.append((r.chunk, r.rows, b"", b"", sums.tobytes(), b""))
        return pd.DataFrame(out, columns=["chunk", "rows", "docs", "runs", "sums", "flags"])

    return answer


def _total(rows: pd.DataFrame) -> pd.DataFrame:
    n = int(rows["rows"].iloc[0])
    sums, ids, words, valid = np.zeros((2, n)), None, None, None
    for r in rows.itertuples():
        if r.docs:
            ids, words = np.frombuffer(r.docs, "<i8"), np.frombuffer(r.runs, "<i8")
            valid = np.unpackbits(np.frombuffer(r.flags, np.uint8))[:n].astype(bool)
            sums += np.frombuffer(r.sums, "<f8").reshape(2, n)
        else:
            sums += np.frombuffer(r.sums, "<f4").reshape(2, n)
    return pd.DataFrame({"doc_id": pd.arrays.IntegerArray(ids.copy(), ~valid), "n_words": words, "background": sums[0], "target": sums[1]})


def cross_entropy_difference(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, target_bits, background_bits (mean loss a word) and ce_difference of every row.

    ``trusted`` has a column doc_id: the documents that the target model is counted over.
    """
    spark = package_reachable(docs.sparkSession)
    texts, sc = id_and_text(docs, id_col, text_col), spark.sparkContext
    texts = marked(texts, trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null"), "doc_id", "target")
    words, total = unigrams(texts)
    vocabulary, shards = sc.broadcast(words), max(8, -(-total // SHARD_WORDS))
    counted = texts.mapInArrow(_count_chunks(vocabulary, shards), "shard long, keys binary, n binary, t binary")
    counts = "{0}keys binary, {0}n binary, {0}t binary"
    model = written(
        counted.repartition(shards, "shard").groupBy("shard").applyInPandas(_shard_counts, f"shard long, {counts.format('')}, {counts.format('f_')}"),
        "bigrams",
    )
    table = np.zeros((FREQUENT, FREQUENT, 2), np.int64)
    for r in model.select("f_keys", "f_n", "f_t").toLocalIterator():
        key = _unpack(r["f_keys"])
        table[key >> 17, key & 0x1FFFF] = np.stack([np.frombuffer(r[c], "<i8") for c in ("f_n", "f_t")], 1)
    chunks = texts.mapInArrow(_document_chunks(vocabulary, sc.broadcast(table), shards), _CHUNK_SCHEMA)
    sums = (
        chunks.repartition(2 * shards, "shard")
        .groupBy("shard")
        .cogroup(model.select("shard", "keys", "n", "t").groupBy("shard"))
        .applyInPandas(_answer(vocabulary), "chunk long, rows long, docs binary, runs binary, sums binary, flags binary")
    )
    done = sums.groupBy("chunk").applyInPandas(_total, "doc_id long, n_words long, background double, target double")
    mean = lambda c: F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words"))
    return done.select(
        "doc_id",
        "n_words",
        mean("target").alias("target_bits"),
        mean("background").alias("background_bits"),
        (mean("target") - mean("background")).alias("ce_difference"),
    )
