"""Operator 7: repeated paragraphs and passages.

A paragraph is a line of at least ``LEAST_WORDS`` words (cut at white space, A-Z lower-cased). MinHash bands
of its 5-word shingles, as many as ``bands_for`` finds for the recall asked, bring paragraphs together;
equal sets are one node, each node of a bucket is paired with the bucket's least, pairs are verified by
exact Jaccard similarity (0.8 or more), and buckets that stay in several components are compared again in
bounded blocks (as in the shingle join). Removals are clustered by connected components.

A repeated passage may also stand inside longer paragraphs, or run over several lines, short ones and
differently broken ones too. So of each run of ``WINDOW`` windows of ``PART`` successive words of a document,
whatever line breaks stand among them, the one of least hash is taken as a part; two documents that share
``WINDOW + PART - 1`` (49) successive words share a part for certain. Parts are clustered when equal.

Of a cluster the occurrence with the smallest id, then the first in its text, stays; all others are to go
(of a part, those in other documents). Overlapping spans of a document are merged.

Null and empty texts and rows with a null id have no paragraphs. Rows repeated with the same id count as
one document: each of their spans is given once. Other columns are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm import arrays as A
from flowlens.llm.common import id_and_text, semi_join, written
from flowlens.llm.parity_join import SET_SCHEMA, bucket_pairs, linked, node_ids, set_batch, sets_of, sorted_buckets

LEAST_WORDS = 20
PART, WINDOW = 24, 26
SIMILARITY, RECALL, ROWS_A_BAND = 0.8, 0.999, 3
_U = np.uint64
_UNITS = 60_000


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS_A_BAND) -> int:
    """Fewest bands of that many rows that bring a pair of that similarity together with that probability."""
    return ceil(log(1 - recall) / log(1 - similarity**rows))


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, first words of all lines and the end, document of each line)."""
    first, _, h, starts = A.words(data, offsets)
    line = np.cumsum(data == 10)[first] if len(first) else first
    doc = A.owner(starts)
    new = np.ones(len(h), bool)
    new[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(new)
    return h, np.append(heads, len(h)), doc[heads]


def paragraphs(h: np.ndarray, starts: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(tokens, their firsts, first word, document) of the shingle sets of long lines, some lines at a time."""
    size = np.diff(starts)
    long = np.flatnonzero(size >= LEAST_WORDS)
    for k in range(0, len(long), _UNITS):
        rows = long[k : k + _UNITS]
        n = size[rows]
        ends = np.concatenate(([0], np.cumsum(n)))
        words = h[np.arange(ends[-1]) - np.repeat(ends[:-1], n) + np.repeat(starts[rows], n)]
        tokens, first = sets_of(words, ends)
        yield tokens, first, rows, doc[rows]


def band_signatures(tokens: np.ndarray, first: np.ndarray, bands: int) -> np.ndarray:
    """Signatures (bands x sets) of non-empty sets."""
    out = np.zeros((bands, len(first) - 1), np.uint64)
    rng = np.random.default_rng(7)
    base = A.mix(tokens + _U(1))
    for b in range(bands):
        for _ in range(ROWS_A_BAND):
            times, plus = rng.integers(1, 1 << 63, 2, dtype=np.uint64)
            low = np.minimum.reduceat((base ^ plus) * (times | _U(1)), first[:-1])
            out[b] = A.mix(out[b] * _U(0x9FB21C651E98DF25) + low)
        out[b] = A.mix(out[b] + _U(b))
    return out


def _slide(x: np.ndarray, n: int, best) -> np.ndarray:
    """best over each run of n elements."""
    width = 1
    while 2 * width <= n:
        x = best(x[: len(x) - width], x[width:])
        width *= 2
    return best(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


def parts(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the windows of PART words that some run of WINDOW windows in a row has as its least."""
    need = PART + WINDOW - 1
    if len(h) < need:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = np.zeros(len(h) - PART + 1, np.uint64)
    for j in range(PART):
        g *= _U(0xC2B2AE3D27D4EB4F)
        g += h[j : j + len(g)]
    g = A.mix(g) | _U(1)
    row = A.owner(starts)
    least = _slide(g, WINDOW, np.minimum)  # of the run that starts at each window
    least[row[: len(least)] != row[need - 1 : need - 1 + len(least)]] = 0  # runs that leave the row
    edge = np.zeros(WINDOW - 1, np.uint64)
    highest = _slide(np.concatenate((edge, least, edge)), WINDOW, np.maximum)  # of the runs that hold each window
    at = np.flatnonzero(highest == g)
    return at, g[at]


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in A.slices(batches):
        h, starts, doc = lines(*A.bytes_of(part.column(1)))
        size = np.diff(starts)
        begin = starts[np.searchsorted(doc, np.arange(part.num_rows + 1))]  # the documents' first words
        units = [(node_ids(t, f), starts[r], size[r], d, np.zeros(len(r), bool)) for t, f, r, d in paragraphs(h, starts, doc)]
        at, g = parts(h, begin)
        units.append((A.mix(g).view(np.int64), at, np.full(len(at), PART), A.owner(begin)[at], np.ones(len(at), bool)))
        for node, word, n, d, is_part in units:
            word = word - begin[d]
            columns = [pa.array(node), part.column(0).take(pa.array(d)), pa.array(word.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(is_part)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "doc_id", "first_word", "n_words", "is_part"])


def _band_rows(bands: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in A.slices(batches):
            for tokens, first, _, _ in paragraphs(*lines(*A.bytes_of(part.column(1)))):
                node, once = np.unique(node_ids(tokens, first), return_index=True)
                sig = band_signatures(tokens, first, bands)[:, once]
                yield pa.RecordBatch.from_arrays([pa.array(sig.ravel().view(np.int64)), pa.array(np.tile(node, bands))], ["sig", "node"])

    return rows


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in A.slices(batches):
        for tokens, first, _, _ in paragraphs(*lines(*A.bytes_of(part.column(1)))):
            yield set_batch(node_ids(tokens, first), tokens, first)


_OCCURRENCE = "node long, doc_id long, first_word long, n_words long, is_part boolean"


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """cluster, doc_id, first_word, n_words, is_part, keep_id, keep_word of every occurrence that is to go."""
    texts = id_and_text(docs, id_col, text_col).where("doc_id is not null")
    buckets = written(sorted_buckets(texts.mapInArrow(_band_rows(bands_for()), "sig long, node long")), "bands")
    pairs = written(bucket_pairs(buckets), "paragraph-pairs")
    nodes = written(pairs.select(F.col("b").alias("node")).union(pairs.select("a")).distinct(), "paragraph-nodes")
    every = written(texts.mapInArrow(_occurrences, _OCCURRENCE), "occurrences")
    wanted = semi_join(every.where("NOT is_part"), nodes, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    found = semi_join(texts, wanted, "doc_id").mapInArrow(_set_rows, SET_SCHEMA)
    sets = written(semi_join(found, nodes, "node").dropDuplicates(["node"]), "paragraph-sets")
    roots = written(linked(buckets, pairs, sets), "paragraph-roots")
    first = F.min(F.struct("doc_id", "first_word"))
    by_node = every.groupBy("node").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))
    alone = by_node.join(roots, "node", "left").where("root is not null or n > 1 and (lo < hi or n > 1)")
    clusters = written(alone.select("node", F.coalesce("root", "node").alias("cluster")), "clusters")
    members = written(every.join(clusters, "node").select("cluster", "doc_id", "first_word", "n_words", "is_part").distinct(), "members")
    keep = written(members.groupBy("cluster").agg(first.alias("keep")), "keep")
    gone = (F.col("doc_id") != F.col("keep.doc_id")) | (~F.col("is_part") & (F.col("first_word") != F.col("keep.first_word")))
    return members.join(keep, "cluster").where(gone).select(
        "cluster", "doc_id", "first_word", "n_words", "is_part", F.col("keep.doc_id").alias("keep_id"), F.col("keep.first_word").alias("keep_word")
    )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, first_word, n_words, keep_id, n_repeats: spans of words that stand elsewhere, merged where they overlap."""
    end = F.col("first_word") + F.col("n_words")
    one = Window.partitionBy("doc_id").orderBy("first_word", "n_words", "cluster")
    before = one.rowsBetween(Window.unboundedPreceding, -1)
    rows = repeats(docs, id_col, text_col).withColumn("end", end).withColumn("reach", F.max("end").over(before))
    island = F.sum(F.when(F.col("first_word") <= F.col("reach"), 0).otherwise(1)).over(one)
    return (
        rows.withColumn("island", island)
        .groupBy("doc_id", "island")
        .agg(F.min("first_word").alias("first_word"), F.max("end").alias("end"), F.min("keep_id").alias("keep_id"), F.count(F.lit(1)).alias("n_repeats"))
        .select("doc_id", "first_word", (F.col("end") - F.col("first_word")).alias("n_words"), "keep_id", "n_repeats")
    )
