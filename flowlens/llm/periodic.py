"""Operator 13: runs of words that repeat with a period, by internal pattern matching.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends with that
period, of at least ``LEAST_TURNS`` periods and ``LEAST_LENGTH`` words. For the power of two m with
q < m <= 2q a run holds an aligned block of m words (a dyadic block) that stands again q words to its right or
to its left. So each block asks for its next occurrence on either side:

* prefix doubling sorts the suffixes of all texts of a slice (words of different texts count as different);
  after the round for m, the suffixes that begin with a block are an interval of the suffix array;
* a wavelet matrix over the suffix array answers range successor and predecessor: the least value above, and
  the greatest below, the block's own place in that interval;
* an occurrence within m words counts. In a window of 2m words the occurrences of a block of m words stand in
  one arithmetic progression, so the nearest one is the only candidate for the period;
* each candidate is grown to both sides (binary search over prefix hashes, then a comparison of the words).

Suffixes whose first two words occur once in their text are left out of the suffix array: no block of two or
more words begins there twice. A block that occurs once asks nothing. All of this is done on whole columns of a
bounded slice of a batch (``arrays.SLICE_BYTES`` of text, or one longer text), so memory follows the slice.
Spark only maps: there is no shuffle, and a lost task is done again from its input.

Words are maximal runs of bytes other than ``[\\x20\\x09-\\x0D]``, compared as written. Null, empty and blank
texts have no words and no runs. Rows are answered one by one: repeated rows get equal results, a null id stays
null. Ties between runs go by start, then period. Other columns are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm import arrays as A
from flowlens.llm.common import id_and_text

LEAST_LENGTH, LEAST_TURNS = 6, 4
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys; for each place in it, the first place of its run of equal keys and that run's size."""
    order = np.argsort(key)
    key = key[order]
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(heads, len(key)))
    return order, np.repeat(heads, size), np.repeat(size, size)


Blocks = list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]


def suffix_array(word: np.ndarray, doc: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, Blocks]:
    """The suffixes whose first two words recur in their text, in order; and the dyadic blocks that recur.

    Blocks are (m, place, from, to): of the suffix array, [from, to) begin with the m words at that place.
    """
    n, blocks = len(word), []
    stop = starts[1:][doc]
    at = np.flatnonzero(np.arange(n) + 1 < stop)
    if not len(at):
        return at, blocks
    name = np.unique(A.mix(word + A.mix((doc.astype(np.uint64) + _U(1)) * _U(_STEP)) * _U(_STEP)), return_inverse=True)[1]
    order, first, size = _groups(name[at] << 32 | name[at + 1])
    at, first, size = at[order][size > 1], first[size > 1], size[size > 1]
    lo = _run_heads(first)
    suffixes, rank, m = np.empty(len(at), np.int64), np.arange(len(at), len(at) + n), 2
    rank[at] = lo
    recur = at
    while len(at):
        aligned = (at - starts[doc[at]]) % m == 0
        blocks.append((m, at[aligned], lo[aligned], (lo + size)[aligned]))
        after = np.where(at + m < stop[at], rank[np.minimum(at + m, n - 1)] + 1, 0)
        order, head, size = _groups(lo << 32 | after)
        at, lo = at[order], lo[order]
        lo = lo + head - _run_heads(lo)
        rank[at] = lo
        at, lo, size = at[size > 1], lo[size > 1], size[size > 1]
        m *= 2
    suffixes[rank[recur]] = recur
    return suffixes, blocks


def _run_heads(x: np.ndarray) -> np.ndarray:
    """For each place, the first place of its run of equal values."""
    new = np.concatenate(([True], x[1:] != x[:-1]))[: len(x)]
    return np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))


class WaveletMatrix:
    """Range rank and range quantile over an array of non-negative numbers, many queries at a time."""

    def __init__(self, values: np.ndarray):
        self.levels = []
        for b in range(int(values.max(initial=0)).bit_length() - 1, -1, -1):
            bit = (values >> b & 1).astype(bool)
            ones = np.concatenate((np.zeros(1, np.int32), np.cumsum(bit, dtype=np.int32)))
            self.levels.append((b, ones, len(values) - int(ones[-1])))
            values = np.concatenate((values[~bit], values[bit]))

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values in [lo, hi) are less than x; x is not above the greatest value."""
        count = np.zeros(len(lo), np.int64)
        for b, ones, zeros in self.levels:
            one_lo, one_hi = ones[lo], ones[hi]
            up = (x >> b & 1).astype(bool)
            count += np.where(up, hi - one_hi - lo + one_lo, 0)
            lo, hi = np.where(up, zeros + one_lo, lo - one_lo), np.where(up, zeros + one_hi, hi - one_hi)
        return count

    def quantile(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th least (from 0) of the values in [lo, hi)."""
        out = np.zeros(len(lo), np.int64)
        for b, ones, zeros in self.levels:
            one_lo, one_hi = ones[lo], ones[hi]
            low = hi - one_hi - lo + one_lo
            up = k >= low
            k = np.where(up, k - low, k)
            out |= up.astype(np.int64) << b
            lo, hi = np.where(up, zeros + one_lo, lo - one_lo), np.where(up, zeros + one_hi, hi - one_hi)
        return out


def candidates(word: np.ndarray, doc: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of dyadic blocks that stand again at most their own length away; the place is that of the
    left one of the two occurrences."""
    suffixes, blocks = suffix_array(word, doc, starts)
    tree = WaveletMatrix(suffixes - starts[doc[suffixes]])
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for m, at, lo, hi in blocks:
        base = starts[doc[at]]
        own = at - base
        rank = tree.below(lo, hi, own)
        for side, has in ((1, rank + 1 < hi - lo), (-1, rank > 0)):
            near = tree.quantile(lo[has], hi[has], rank[has] + side)
            gap = side * (near - own[has])
            close = gap <= m
            places.append((base[has] + np.minimum(near, own[has]))[close])
            periods.append(gap[close])
    return np.concatenate(places), np.concatenate(periods)


def _grown(word: np.ndarray, place: np.ndarray, period: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the longest stretch in [low, high) around place and place + period with that period."""
    power = np.full(len(word) + 1, _STEP, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(A.mix(word) * power[:-1], dtype=np.uint64)))

    def equal(a, b):  # words [a, b) and those a period later
        return (total[b] - total[a]) * power[period] == total[b + period] - total[a + period]

    ends = []
    for most, span in (
        (high - period - place, lambda k: (place, place + k)),
        (place - low, lambda k: (place - k, place)),
    ):
        good, bad = np.zeros(len(place), np.int64), most + 1
        while (open_ := bad - good > 1).any():
            k = np.where(open_, (good + bad) // 2, good)
            ok = equal(*span(k))
            good, bad = np.where(open_ & ok, k, good), np.where(open_ & ~ok, k, bad)
        ends.append(good)
    return place - ends[1], place + ends[0] + period


def runs(word: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, period) of all runs of the texts whose word numbers begin at starts, in that order."""
    doc = A.owner(starts)
    place, period = candidates(word, doc, starts)
    if not len(place):
        return place, place, period
    low, high = starts[doc[place]], starts[doc[place] + 1]
    first, end = _grown(word, place, period, low, high)
    found, source = np.unique(np.stack((first, end, period)), axis=1, return_inverse=True)
    wrong = [not _is_run(word, *run) for run in found.T.tolist()]
    for i in np.flatnonzero(np.array(wrong)[source.ravel()]):  # prefix hashes of different words agreed
        first[i], end[i] = _grown_by_words(word, place[i], period[i], low[i], high[i])
    long = end - first >= np.maximum(LEAST_LENGTH, LEAST_TURNS * period)
    first, end, period = np.unique(np.stack((first[long], end[long], period[long])), axis=1) if long.any() else np.zeros((3, 0), np.int64)
    by = np.lexsort((period, first))
    return first[by], end[by], period[by]


def _is_run(word: np.ndarray, first: int, end: int, period: int) -> bool:
    """Whether the stretch has the period, by the words. (That no neighbour extends it is sure: unequal hashes are of unequal words.)"""
    return bool((word[first : end - period] == word[first + period : end]).all())


def _grown_by_words(word: np.ndarray, place: int, period: int, low: int, high: int) -> tuple[int, int]:
    apart = word[low : high - period] != word[low + period : high]
    left, right = np.flatnonzero(apart[: place - low]), np.flatnonzero(apart[place - low :])
    return (low + left[-1] + 1 if len(left) else low), (place + right[0] + period if len(right) else high)


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """The place that each of a text's n words is taken from, where the id says that its end repeats; else None."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


Alter = Callable[[int, int | None], np.ndarray | None]


def _texts(batches: Iterator[pa.RecordBatch], alter: Alter | None):
    """Per slice: ids, raw words of each text (lists), first words, and its runs; ``alter`` may reorder words."""
    for part in A.slices(batches):
        data, offsets = A.bytes_of(part.column(1))
        _, _, word, starts = A.words(data, offsets, lower=False)
        ids, raw, at = part.column(0).to_pylist(), data.tobytes(), offsets.tolist()
        texts = [raw[a:b].split() for a, b in zip(at, at[1:])]
        if alter is not None:
            source = np.arange(len(word))
            for i, (doc_id, text) in enumerate(zip(ids, texts)):
                taken = alter(len(text), doc_id)
                if taken is not None:
                    source[starts[i] : starts[i + 1]] = starts[i] + taken
                    texts[i] = [text[k] for k in taken.tolist()]
            word = word[source]
        yield ids, texts, starts, *runs(word, starts)


def kept_words(starts: np.ndarray, first: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words no run holds after its first period."""
    steps = np.zeros(starts[-1] + 1, np.int64)
    np.add.at(steps, first + period, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps)[:-1] == 0


def _collapsed(texts: list[list[bytes]], starts: np.ndarray, keep: np.ndarray) -> Iterator[bytes]:
    dropped = np.add.reduceat(np.append(~keep, False).astype(np.int64), starts[:-1]) if len(starts) > 1 else []
    for i, text in enumerate(texts):
        if text and dropped[i]:
            text = [text[k] for k in np.flatnonzero(keep[starts[i] : starts[i + 1]]).tolist()]
        yield b" ".join(text)


RUN = "doc_id long, start long, length long, period long"


def _run_rows(batches):
    for ids, _, starts, first, end, period in _texts(batches, None):
        doc = np.searchsorted(starts, first, "right") - 1
        columns = [pa.array([ids[k] for k in doc.tolist()], pa.int64()), first - starts[doc], end - first, period]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "start", "length", "period"])


def _text_rows(batches):
    for ids, texts, starts, *found in _texts(batches, None):
        out = [t.decode() for t in _collapsed(texts, starts, kept_words(starts, *found))]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], ["doc_id", "text"])


DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def _digest_rows(alter: Alter | None):
    def rows(batches):
        for ids, texts, starts, first, end, period in _texts(batches, alter):
            cut = np.searchsorted(first, starts).tolist()
            collapsed = _collapsed(texts, starts, kept_words(starts, first, end, period))
            out = []
            for i, text in enumerate(collapsed):
                a, b = cut[i], cut[i + 1]
                mine = list(zip((first[a:b] - starts[i]).tolist(), (end[a:b] - first[a:b]).tolist(), period[a:b].tolist()))
                best = max(mine, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in mine).encode()
                milli = 1000 * best[1] // best[2] if mine else None
                out.append((ids[i], len(mine), *best, milli, hashlib.sha256(listed).hexdigest(), hashlib.sha256(text).hexdigest()))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            names = [field.split()[0] for field in DIGEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return rows


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, period of every run; start is a word number from 0."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_run_rows, RUN)


def collapsed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text of every row: its words, joined by a space, without those that a run holds after its first period."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_text_rows, "doc_id long, text string")


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alter: Alter | None = None) -> DataFrame:
    """doc_id, n_runs, the longest run and the hashes of all runs and of the collapsed text of every row.

    ``alter`` (number of words, id) may name the place that each word is to be taken from first.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(_digest_rows(alter), DIGEST)
