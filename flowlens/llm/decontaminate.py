"""Operator 8: benchmark passages in documents, by spaced seeds.

Texts are read as words (bytes lower-cased for A-Z, cut at white space). Each of 25 fixed masks looks
at 6 of 12 successive words and ignores the rest, so a window still hashes alike where a substituted word
falls on an ignored place. The masks were chosen so that, wherever the substitutions fall in a run that
the comparison accepts, some mask at some place of the run sees none of them. Window hashes of the benchmark are joined with those of all documents; a hit
fixes an alignment (document word minus item word), on which all words of the item are then compared. A
hit stands if some run of ``RUN`` successive words of the item (all, if it has fewer) has at least
``SHARE`` of its words equal; words past an end of the document count as unequal, and at least 12 words of
the item must lie in it (all, if it has fewer).

The benchmark is read in blocks of about ``BLOCK_WORDS`` words; each block's index is broadcast (its size
has that bound) and all documents pass by it, so a benchmark of any size works without a shuffle. Items of
8 to 11 words, shorter than a mask, are found where all their words stand in a row; items under 8 words
say too little and are never found, nor are null or empty ones. Null and empty documents hold nothing.
Repeated rows are found each; a null id is carried as null. An empty table on either side gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import arrays as A
from flowlens.llm.common import anti_join, id_and_text

MASKS = (
    "110001001011", "101110100001", "010100010111", "101100011001", "000010101111",
    "111011000001", "111010011000", "100100001111", "111001010100", "001001100111",
    "100011110010", "000011011101", "110110100100", "001010010111", "010101111000",
    "000001111011", "110101100010", "011011001010", "001100111100", "011111100000",
    "111010000110", "100110101001", "110000101101", "000111001110", "000010111011",
)
LEAST_WORDS = 8
RUN, SHARE = 20, 0.7
BLOCK_WORDS = 200_000
_SIEVE_BITS = 22
_MOST_HITS = 1 << 20
_SCHEMA = "doc_id long, item_id long, first_word long, n_words long, n_equal long"


def seed_hashes(h: np.ndarray, starts: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of each window that lies within one row, over the mask's places."""
    span = len(mask)
    if len(h) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    whole = len(h) - span + 1
    g = np.full(whole, int(mask, 2), np.uint64)
    for j, used in enumerate(mask):
        if used == "1":
            g *= np.uint64(0xC2B2AE3D27D4EB4F)
            g += h[j : j + whole]
    row = A.owner(starts)
    inside = np.flatnonzero(row[:whole] == row[span - 1 :])
    return inside, A.mix(g[inside])


class Index:
    """Seeds of one block of the benchmark, with its words for the comparison."""

    def __init__(self, items: pa.Table):
        data, offsets = A.bytes_of(items.column(1).combine_chunks())
        _, _, self.h, self.starts = A.words(data, offsets)
        self.ids = items.column(0).to_numpy()
        size = np.diff(self.starts)
        span = len(MASKS[0])
        self.masks = list(MASKS) + ["1" * n for n in range(LEAST_WORDS, span) if (size == n).any()]
        self.row = A.owner(self.starts)
        at, key = [], []
        for mask in self.masks:
            pos, g = seed_hashes(self.h, self.starts, mask)
            if len(mask) < span:
                whole = size[self.row[pos]] == len(mask)
                pos, g = pos[whole], g[whole]
            at.append(pos)
            key.append(g)
        key, at = np.concatenate(key), np.concatenate(at)
        order = np.argsort(key, kind="stable")
        self.key, self.at = key[order], at[order]
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[key & np.uint64((1 << _SIEVE_BITS) - 1)] = True

    def hits(self, h: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document word, item word) pairs with a seed in common, in bounded pieces."""
        for mask in self.masks:
            pos, g = seed_hashes(h, starts, mask)
            some = self.sieve[g & np.uint64((1 << _SIEVE_BITS) - 1)]
            pos, g = pos[some], g[some]
            lo, hi = np.searchsorted(self.key, g, "left"), np.searchsorted(self.key, g, "right")
            n = hi - lo
            k, ends = 0, np.cumsum(n)
            while k < len(n):
                m = max(int(np.searchsorted(ends, (ends[k - 1] if k else 0) + _MOST_HITS, "right")), k + 1)
                c = n[k:m]
                if c.sum():
                    skip = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                    yield np.repeat(pos[k:m], c), self.at[np.repeat(lo[k:m], c) + skip]
                k = m

    def overlaps(self, h: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Verified (row, item id, first word, words, equal words), the best alignment of each row and item."""
        rows = A.owner(starts)
        lines: set[tuple[int, int, int]] = set()
        for word, item_word in self.hits(h, starts):
            row, item = rows[word], self.row[item_word]
            shift = (word - starts[row]) - (item_word - self.starts[item])
            lines.update(map(tuple, np.unique(np.stack((row, item, shift), 1), axis=0).tolist()))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for row, item, shift in lines:
            text, own = h[starts[row] : starts[row + 1]], self.h[self.starts[item] : self.starts[item + 1]]
            a, b = max(0, -shift), min(len(own), len(text) - shift)
            equal = text[a + shift : b + shift] == own[a:b]
            run = min(RUN, len(own))
            if b - a < min(run, len(MASKS[0])):
                continue
            sums = np.concatenate((np.zeros(a + 1, int), np.cumsum(equal), np.full(len(own) - b, equal.sum())))
            if (sums[run:] - sums[:-run]).max() < SHARE * run:
                continue
            found = (int(equal.sum()), -(a + shift), b - a)
            best[row, item] = max(best.get((row, item), found), found)
        return [(r, int(self.ids[i]), -at, n, e) for (r, i), (e, at, n) in sorted(best.items())]


def _with_index(shared):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in A.slices(batches, limit=A.SLICE_BYTES // 2):
            _, _, h, starts = A.words(*A.bytes_of(part.column(1)))
            found = shared.value.overlaps(h, starts)
            if found:
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(columns[0])), *(pa.array(c, pa.int64()) for c in columns[1:])],
                    ["doc_id", "item_id", "first_word", "n_words", "n_equal"],
                )

    return find


def benchmark_overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """doc_id, item_id, first_word, n_words, n_equal: where in a document an item stands, and how much of it."""
    texts, spark = id_and_text(docs, id_col, text_col), docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where(
        "item_id is not null and text is not null"
    )
    words = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-words // (6 * BLOCK_WORDS))
    found = None
    for k in range(blocks):
        index = Index(items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).orderBy("item_id").toArrow())
        part = texts.mapInArrow(_with_index(spark.sparkContext.broadcast(index)), _SCHEMA)
        found = part if found is None else found.union(part)
    return spark.createDataFrame([], _SCHEMA) if found is None else found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, in which no benchmark item was found; rows with a null id stay."""
    return anti_join(docs, benchmark_overlaps(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(id_col)), id_col)
