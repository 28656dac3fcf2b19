"""Operator 1: quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

Words (cut at white space, A-Z lower-cased) of trusted documents are counted as trigrams; lower orders use
continuation counts; each order has three discounts from its counts of counts; the last order falls back on
equal shares of an open vocabulary. All trusted text of the training half is counted.

Words are numbered by frequency in trusted text: the ``VOCABULARY`` most frequent at most, by broadcast; others are told by
their hash, or are one unknown word where all words of trusted text have numbers. Each place of a text, a word with its
neighbours, is dealt to a slot by that word, so that a slot has all trigrams about the word, all bigrams that begin
with it and all contexts that end with it. The places of a frequent word are spread over several slots by its neighbours
too; its bigrams and contexts are then added up by aggregates and sent to these slots. Slots count trusted text first;
discounts, and the numbers of words before a word, are added up over all slots. A word's log2 probability is a sum of what
its trigram, bigram and word add, each nothing where the model hasn't got it, so the same slots then add these up for the
places of all documents: a chunk of text deals its places, packed and compressed, and adds up what the slots send
back to each document. Neither text nor model passes the driver or one task whole, and what is moved is the text's places once.
The number of slots follows the bytes of text.

Half of the trusted documents, by id, may be trained on; the other half sets the limits. A document is
rejected if its mean log2 loss a word is over the ``HIGH`` quantile of its language's trusted documents by
more than ``MARGIN_BITS``. The mean of a short document is drawn to its language's trusted mean by
``PRIOR_WORDS`` words. A language with under ``LEAST_TRUSTED`` such documents, or none given, is judged by
all of them; if there are none at all, all is kept. There is no lower limit: copies of trusted text have
the lowest losses.

Null, empty and blank texts have no words and no perplexity (null) and are kept. Repeated rows are judged
alike; a null id is never trusted. Without trusted rows all documents are kept. Other columns are carried by
the filter and may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import arrays as A
from flowlens.llm.common import BROADCAST_ROWS, id_and_text, package_reachable, semi_join, written

CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 60_000
SLOT_BYTES = 32_000_000
VOCABULARY = 1 << 21
HIGH = 0.998
MARGIN_BITS = 0.5
PRIOR_WORDS = 20
LEAST_TRUSTED = 50
_U = np.uint64
_START = _U(0x5851F42D4C957F2D)
#: Names of words: the mark after the last word, any word that no trusted text has, then the numbered words; of a word that
#: isn't numbered, its hash with the highest bit set.
_END, _NEW, _FIRST, _RARE = _U(0), _U(1), 2, _U(1 << 63)
_WIDE = _U(0xFFFFFF)
#: Set the kinds of keys apart: trigrams, bigrams, words.
_TAGS = {"three": 0x1F3D5B79, "two": 0x3D5B7997, "one": 0x5B7997B5}


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return A.mix(a * _U(0xC2B2AE3D27D4EB4F) + b)


def _key(kind: str, *words: np.ndarray) -> np.ndarray:
    k = words[0]
    for w in words[1:]:
        k = pair(k, w)
    return A.mix(k + _U(_TAGS[kind]))


def _heads(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.zeros(len(sorted_columns[0]), bool)
    new[:1] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of trusted text, by hash, and how often; the start mark counts once a document."""
    for part in A.slices(batches):
        _, _, h, starts = A.words(*A.bytes_of(part.column(1)))
        if len(h):
            h, n = np.unique(h, return_counts=True)
            full = np.count_nonzero(np.diff(starts))
            yield pa.RecordBatch.from_arrays([_long(np.append(h, _START)), pa.array(np.append(n, full))], ["h", "n"])


@dataclass
class Names:
    """What map tasks get by broadcast: hashes of the numbered words, their numbers, whether all words of trusted
    text are numbered; names of frequent words and over how many slots each is spread."""

    hashes: np.ndarray
    numbers: np.ndarray
    closed: bool
    hot: np.ndarray
    parts: np.ndarray

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(h), _NEW)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        other = np.full(len(h), _NEW) if self.closed else h | _RARE
        return np.where(self.hashes[at] == h, self.numbers[at], other)

    def is_hot(self, v: np.ndarray) -> np.ndarray:
        return np.isin(v, self.hot)

    def slots(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, slots: int) -> np.ndarray:
        """Slot of each word and its neighbours: by the word; by all three if the word is frequent."""
        part = np.zeros(len(v), np.uint64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, v), len(self.hot) - 1)
            hot = self.hot[at] == v
            part[hot] = pair(u[hot], w[hot]) % self.parts[at[hot]]
        return _slot(v, part, slots)


def _slot(v: np.ndarray, part: np.ndarray, slots: int) -> np.ndarray:
    return (pair(v, part) % _U(slots)).astype(np.int64)


def _places(names: Names, h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each word and each document's start mark: the word before it, itself, the word after it, its document."""
    n = np.diff(starts)
    first = starts[:-1][n > 0]
    start = names.of(np.array([_START]))[0]
    v = np.insert(names.of(h), first, start)
    at = first + np.arange(len(first))  # of the marks
    u, w = np.roll(v, 1), np.roll(v, -1)
    u[at] = start
    w[at - 1] = _END  # of the document before; the first's is the last
    return u, v, w, np.repeat(np.arange(len(n)), n + (n > 0))


def _planes(x: np.ndarray, size: int) -> list[bytes]:
    """The lowest bytes of numbers, compressed apart: high ones of small numbers take next to nothing."""
    raw = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T[:size])
    return [pa.compress(p.tobytes(), codec="zstd", asbytes=True) for p in raw]


def _packed(v: np.ndarray, u: np.ndarray, w: np.ndarray, number: np.ndarray) -> bytes:
    """Rows sorted by v, as one value."""
    parts = _planes(np.diff(np.minimum(v, _WIDE), prepend=_U(0)), 3)
    for x in (u, w):
        parts += _planes(np.minimum(x, _WIDE), 3)
    parts += _planes(number, 4)
    for x in (v, u, w):
        parts.append(x[x >= _WIDE].tobytes())
    return np.array([len(v), *map(len, parts)], "<u8").tobytes() + b"".join(parts)


_PARTS = 3 * 3 + 4 + 3


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, *sizes = np.frombuffer(data, "<u8", _PARTS + 1).astype(int)
    cut = np.cumsum([8 * (_PARTS + 1), *sizes])
    parts = [data[a:b] for a, b in zip(cut[:-1], cut[1:])]

    def number(planes: list[bytes]) -> np.ndarray:
        out = np.zeros((n, 4), np.uint8)
        for i, p in enumerate(planes):
            out[:, i] = np.frombuffer(pa.decompress(p, decompressed_size=int(n), codec="zstd", asbytes=True), np.uint8)
        return out.view("<u4").ravel().astype(np.uint64)

    words = [np.cumsum(number(parts[0:3]), dtype=np.uint64), number(parts[3:6]), number(parts[6:9])]
    for x, wide in zip(words, parts[13:]):
        x[x >= _WIDE] = np.frombuffer(wide, np.uint64)
    return *words, number(parts[9:13])


def _types(u: np.ndarray, v: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows by v, u, w, and their summed n."""
    order = np.lexsort((w, u, v))
    u, v, w, n = u[order], v[order], w[order], n[order]
    heads = _heads(v, u, w)
    return u[heads], v[heads], w[heads], np.add.reduceat(n, heads) if len(heads) else n


def _deal_types(names, slots: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in A.slices(batches, limit=CHUNK_BYTES):
            _, _, h, starts = A.words(*A.bytes_of(part.column(1)))
            u, v, w, _ = _places(names.value, h, starts)
            there = w != _END
            u, v, w, n = _types(u[there], v[there], w[there], np.ones(np.count_nonzero(there), np.int64))
            slot = names.value.slots(u, v, w, slots)
            for s in np.unique(slot):
                here = slot == s
                yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([_packed(v[here], u[here], w[here], n[here])], pa.binary())], ["slot", "data"])

    return deal


#: What a slot makes of its trusted text, by kind: its trigrams, packed; bigrams (a, b) of a frequent word a by n, the number of words
#: before them; contexts (a, b) with a frequent word b by total n and types of count 1, 2, 3 or more; words by n, the number
#: of words before them; words that aren't numbered, for each slot that has to know n; types of order a and count b.
_TRIGRAMS, _TWO, _CONTEXT, _ONE, _WANTED, _COUNTS = range(6)
_SLOT_SCHEMA = "kind int, slot long, a long, b long, n long, m1 long, m2 long, m3 long, data binary"
_SLOT = [f.split()[0] for f in _SLOT_SCHEMA.split(", ")]
_SLOT_ARROW = pa.schema([(c, pa.int32() if c == "kind" else pa.binary() if c == "data" else pa.int64()) for c in _SLOT])


def _by_count(n: np.ndarray, group: np.ndarray, groups: int) -> list[np.ndarray]:
    """For each group the number of rows with n 1, 2, 3 or more."""
    return [np.bincount(group[m], minlength=groups) for m in (n == 1, n == 2, n >= 3)]


def _grouped(*sorted_columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal rows begin, and the run of each row."""
    heads = _heads(*sorted_columns)
    return heads, np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(sorted_columns[0]))))


def _bigrams(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (v, w), and how often."""
    order = np.lexsort((w, v))
    v, w = v[order], w[order]
    heads = _heads(v, w)
    return v[heads], w[heads], np.diff(np.append(heads, len(v)))


def _count(names, slots: int):
    def count(rows: pa.Table) -> pa.Table:
        blocks = [_unpacked(d) for d in rows["data"].to_pylist()]
        v, u, w, n = (np.concatenate(c) for c in zip(*blocks))
        u, v, w, n = _types(u, v, w, n)
        out = []

        def put(kind: int, size: int, **columns):
            full = {"kind": np.full(size, kind, np.int32), "slot": np.full(size, rows["slot"][0].as_py())}
            full |= {c: _long(x) for c, x in columns.items() if c != "data"} | {c: x for c, x in columns.items() if c == "data"}
            out.append(pa.table([pa.array(full[f.name], f.type) if f.name in full else pa.nulls(size, f.type) for f in _SLOT_ARROW], _SLOT_ARROW))

        put(_TRIGRAMS, 1, n=np.array([len(v)]), data=[_packed(v, u, w, n)])
        hot = names.value.is_hot(v)
        a, b, times = _bigrams(v[hot], w[hot])
        put(_TWO, len(a), a=a, b=b, n=times)
        heads, run = _grouped(v[hot], u[hot])
        m1, m2, m3 = _by_count(n[hot], run, len(heads))
        total = np.bincount(run, n[hot].astype(np.float64), len(heads)).astype(np.int64)
        put(_CONTEXT, len(heads), a=u[hot][heads], b=v[hot][heads], n=total, m1=m1, m2=m2, m3=m3)
        a, b, times = _bigrams(v[~hot], w[~hot])
        one, after = np.unique(b, return_counts=True)
        put(_ONE, len(one), a=one, n=after)
        rare, own = (np.unique(x[x >= _RARE]) for x in (b, w))
        put(_WANTED, len(rare), a=rare)
        put(_WANTED, len(own), a=own, slot=_slot(own, np.zeros(len(own), np.uint64), slots))
        for order, c in ((3, n), (2, times)):
            c = np.bincount(np.minimum(c, 5).astype(int), minlength=6)[1:]
            put(_COUNTS, 5, a=np.full(5, order), b=np.arange(1, 6), n=c)
        A.give_back()
        return pa.concat_tables(out)

    return count


def discounts(n: dict[int, int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more, from the counts of counts."""
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9
    return tuple(min(max(v, 0.05), i + 0.95) for i, v in enumerate(d))


def _count_types(n: DataFrame) -> dict[int, int]:
    """Rows of n 1, 2, 3, 4, and of 5 or more."""
    return {r["n"]: r["types"] for r in n.select(F.least("n", F.lit(5)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("types")).collect()}


def _taken(d: tuple[float, float, float], n: np.ndarray) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(n, 3).astype(int)]


def _sum(values, group: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount(group, values.astype(np.float64), groups)


@dataclass
class Model:
    """Rows of each slot (kinds ``_TRIGRAMS``, ``_TWO`` with the words before b in m1, ``_CONTEXT``, ``_WANTED`` with n), and what
    all slots need: names, numbers of words before the numbered words, discounts of each order, the sum of all such
    numbers, share of an unseen word."""

    table: DataFrame
    names: Names
    slots: int
    before: np.ndarray
    discounts: dict[int, tuple[float, float, float]]
    total: int
    unseen: float
    entries: int


def _text_bytes(texts: DataFrame, text_col: str = "text") -> int:
    return texts.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0


def _names(words: DataFrame, slots: int) -> Names:
    """The ``VOCABULARY`` most frequent words, less those that tie with the first one left out, are numbered by frequency."""
    size, total = words.agg(F.count(F.lit(1)), F.sum("n")).first()
    least = 1
    if size and size > VOCABULARY:
        taken, least = 0, total + 1
        for r in words.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
            taken += r["count"]
            if taken > VOCABULARY:
                break
            least = r["n"]
    if not size:
        return Names(*[np.zeros(0, np.uint64)] * 2, True, *[np.zeros(0, np.uint64)] * 2)
    top = words.where(F.col("n") >= least).toArrow()
    h, n = top["h"].to_numpy().view(np.uint64), top["n"].to_numpy()
    numbers = np.empty(len(h), np.uint64)
    numbers[np.lexsort((h, -n))] = np.arange(_FIRST, _FIRST + len(h), dtype=np.uint64)
    parts = -(-n * slots // (2 * total))  # a part has the words of two slots at most
    hot = parts > 1
    order, by = np.argsort(h), np.argsort(numbers[hot])
    return Names(h[order], numbers[order], len(h) == size, numbers[hot][by], parts[hot][by].astype(np.uint64))


def train(texts: DataFrame, size: int | None = None) -> Model:
    """The model of all the texts, for scoring ``size`` bytes of text (by default, as many as they have)."""
    spark, sc = texts.sparkSession, texts.sparkSession.sparkContext
    slots = max(8, -(-(_text_bytes(texts) if size is None else size) // SLOT_BYTES))
    words = texts.mapInArrow(_word_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    names = _names(written(words, "kn-words"), slots)
    shared = sc.broadcast(names)
    dealt = texts.mapInArrow(_deal_types(shared, slots), "slot long, data binary").repartition(2 * slots, "slot")
    made = written(dealt.groupBy("slot").applyInArrow(_count(shared, slots), _SLOT_SCHEMA), "kn-slots", by="kind")
    kind = lambda k: made.where(F.col("kind") == k)
    two = written(kind(_TWO).groupBy("a", "b").agg(F.sum("n").alias("n")), "kn-2")
    one = kind(_ONE).select("a", "n").union(two.groupBy("b").agg(F.count(F.lit(1)).alias("n")))
    one = written(one.groupBy("a").agg(F.sum("n").alias("n")), "kn-1")
    counts: dict[int, dict[int, int]] = {1: _count_types(one), 2: _count_types(two), 3: {}}
    for r in kind(_COUNTS).groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        counts[r["a"]][r["b"]] = counts[r["a"]].get(r["b"], 0) + r["n"]
    types = {order: sum(n.values()) for order, n in counts.items()}
    d = {order: discounts(n) for order, n in counts.items()}
    total = one.agg(F.sum("n")).first()[0] or 0
    unseen = sum(n * _taken(d[1], np.array(i)) for i, n in counts[1].items()) / total / (types[1] + 1) if total else 0.0
    numbered = one.where(F.col("a") >= 0).toArrow()
    before = np.zeros(_FIRST + len(names.hashes), np.int64)
    before[numbered["a"].to_numpy()] = numbered["n"].to_numpy()
    ends = sorted({(int(v), int(_slot(np.array([v]), np.array([p], np.uint64), slots)[0])) for v, k in zip(names.hot, names.parts) for p in range(int(k))})
    ends = F.broadcast(spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, s) for v, s in ends], "v long, to long"))
    only = one.select(F.col("a").alias("word"), F.col("n").alias("before"))
    contexts = kind(_CONTEXT).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "m1", "m2", "m3")])
    none = F.lit(None).cast("long")
    table = kind(_TRIGRAMS).select(_SLOT)
    for k, rows, m in (
        (_TWO, two.join(only, F.col("b") == F.col("word")).join(ends, F.col("a") == F.col("v")), ["a", "b", "n", F.col("before"), none, none]),
        (_CONTEXT, contexts.join(ends, F.col("b") == F.col("v")), ["a", "b", "n", "m1", "m2", "m3"]),
        (_WANTED, kind(_WANTED).select(F.col("slot").alias("to"), "a").distinct().join(only, F.col("a") == F.col("word")), ["a", none, F.col("before"), none, none, none]),
    ):
        table = table.union(rows.select(F.lit(k), "to", *m, F.lit(None).cast("binary")))
    return Model(table, names, slots, before, d, total, unseen, types[3] + 2 * (types[2] + types[1]))


def lookup(sorted_keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Value of each wanted key, 0 where there is none."""
    out = np.zeros(len(wanted))
    if len(sorted_keys):
        at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
        hit = sorted_keys[at] == wanted
        out[hit] = values[at[hit]]
    return out


def _by_key(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(key)
    return key[order], *(x[order] for x in values)


class _SlotModel:
    """What a slot's n-grams add to a word's log2 probability, by key."""

    def __init__(self, rows: pa.Table, before: np.ndarray, names: Names, d: dict, total: int, unseen: float):
        of = {k: rows.filter(pa.array(rows["kind"].to_numpy() == k)) for k in (_TRIGRAMS, _TWO, _CONTEXT, _WANTED)}
        column = lambda k, c: of[k][c].to_numpy().view(np.uint64)
        self.before, self.d, self.total, self.unseen = before, d, total, unseen
        self.rare = _by_key(column(_WANTED, "a"), column(_WANTED, "n"))
        blocks = [_unpacked(x) for x in of[_TRIGRAMS]["data"].to_pylist()] or [[np.zeros(0, np.uint64)] * 4]
        v, u, w, n = (np.concatenate(c) for c in zip(*blocks))
        hot = names.is_hot(v)
        # bigrams
        a, b, times = _bigrams(v[~hot], w[~hot])
        q = np.concatenate((self.share(self.words_before(b)), self.share(column(_TWO, "m1"))))
        a, b, times = (np.concatenate(c) for c in ((a, column(_TWO, "a")), (b, column(_TWO, "b")), (times, column(_TWO, "n").astype(np.int64))))
        word, run = np.unique(a, return_inverse=True)
        sums, taken = _sum(times, run, len(word)), _taken(d[2], times)
        gamma = _sum(taken, run, len(word)) / sums
        p = (times - taken) / sums[run] + gamma[run] * q
        self.two = _by_key(_key("two", a, b), np.log2(p / (gamma[run] * q)), p)
        self.after_one = word, np.log2(gamma)
        # trigrams
        heads, run = _grouped(v, u)
        sums, taken = _sum(n, run, len(heads)), _taken(d[3], n)
        freed = _sum(taken, run, len(heads))
        context = _key("two", u[heads], v[heads])
        m = [column(_CONTEXT, c).astype(np.float64) for c in ("n", "m1", "m2", "m3")]
        cold = ~hot[heads]
        keys = np.concatenate((context[cold], _key("two", column(_CONTEXT, "a"), column(_CONTEXT, "b"))))
        sums = np.concatenate((sums[cold], m[0]))
        gamma = np.concatenate((freed[cold], m[1] * d[3][0] + m[2] * d[3][1] + m[3] * d[3][2])) / sums
        self.after_two = _by_key(keys, np.log2(gamma), gamma, sums)
        gamma, sums = (lookup(self.after_two[0], x, context)[run] for x in self.after_two[2:])
        lower = gamma * lookup(self.two[0], self.two[2], _key("two", v, w))
        self.three = _by_key(_key("three", u, v, w), np.log2((n - taken) / sums / lower + 1))

    def share(self, before: np.ndarray) -> np.ndarray:
        return (before - _taken(self.d[1], before)) / self.total + self.unseen

    def words_before(self, words: np.ndarray) -> np.ndarray:
        out = lookup(*self.rare, words)
        known = words < _U(len(self.before))
        out[known] = self.before[words[known].astype(int)]
        return out

    def gains(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What word v adds as one that no word is before, and the words before w to its share of that kind."""
        out = np.log2(self.share(self.words_before(v)) / self.unseen)
        more = lookup(*self.after_one, v) + lookup(*self.two[:2], _key("two", v, w))
        more += lookup(*self.after_two[:2], _key("two", u, v)) + lookup(*self.three, _key("three", u, v, w))
        return out + np.where(w == _END, 0.0, more)


#: A chunk's row for a slot: its words there, packed, with their documents. A chunk's own row (negative slot): in ``data``
#: the other columns of its documents, in ``words`` their numbers of words.
_CHUNK_SCHEMA = "slot long, chunk long, data binary, words binary"
_CHUNK = [f.split()[0] for f in _CHUNK_SCHEMA.split(", ")]


def _row(slot: int, chunk: int, data: bytes, words: bytes) -> pa.RecordBatch:
    kinds = [pa.int64()] * 2 + [pa.binary()] * 2
    return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip((slot, chunk, data, words), kinds)], _CHUNK)


def _chunks(names, slots: int, text_col: str):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for part in A.slices(batches, text_col, CHUNK_BYTES):
            for at in range(0, part.num_rows, CHUNK_ROWS):
                number += 1
                yield from chunk_rows(TaskContext.get().partitionId() << 32 | number, part.slice(at, CHUNK_ROWS))

    def chunk_rows(chunk, rows):
        place = rows.schema.get_field_index(text_col)
        _, _, h, starts = A.words(*A.bytes_of(rows.column(place)))
        other = rows.select([c for c in rows.schema.names if c != text_col])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, other.schema) as out:
            out.write_batch(other)
        yield _row(-1 - chunk % slots, chunk, sink.getvalue().to_pybytes(), np.diff(starts).astype("<i8").tobytes())
        u, v, w, doc = _places(names.value, h, starts)
        known = v != _NEW  # any other word and what follows it add nothing
        u, v, w, doc = u[known], v[known], w[known], doc[known]
        slot = names.value.slots(u, v, w, slots)
        order = np.lexsort((v, slot))  # documents stay in order
        u, v, w, doc, slot = u[order], v[order], w[order], doc[order], slot[order]
        cut = np.searchsorted(slot, np.arange(slots + 1))
        for s in np.flatnonzero(np.diff(cut)):
            here = slice(cut[s], cut[s + 1])
            steps = np.diff(doc[here], prepend=0) % len(starts)
            yield _row(s, chunk, _packed(v[here], u[here], w[here], steps), len(starts).to_bytes(8, "little"))

    return chunks


_ANSWER_SCHEMA = "chunk long, other binary, words binary, docs binary, sums binary"
_ANSWER = pa.schema([("chunk", pa.int64()), *((f.split()[0], pa.binary()) for f in _ANSWER_SCHEMA.split(", ")[1:])])


def _answer(names, before, d: dict, total: int, unseen: float):
    def answer(chunks: pa.Table, rows: pa.Table) -> pa.Table:
        """What one slot's n-grams add to the documents of each chunk; a chunk's own row passes through."""
        model = None
        out = {name: [] for name in _ANSWER.names}
        for batch in chunks.to_batches(max_chunksize=1):
            r = {name: batch.column(i)[0].as_py() for i, name in enumerate(batch.schema.names)}
            if r["slot"] < 0:
                new = r["chunk"], r["data"], r["words"], b"", b""
            else:
                model = model or _SlotModel(rows, before.value, names.value, d, total, unseen)
                v, u, w, steps = _unpacked(r["data"])
                doc = np.cumsum(steps) % _U(int.from_bytes(r["words"], "little"))
                doc, back = np.unique(doc, return_inverse=True)
                sums = np.bincount(back, model.gains(u, v, w), len(doc))
                new = r["chunk"], b"", b"", doc.astype("<u2").tobytes(), sums.astype("<f4").tobytes()
            for c, x in zip(out.values(), new):
                c.append(x)
        del model
        A.give_back()
        return pa.table(out, _ANSWER)

    return answer


def _total(words: str, bits: str, unseen: float):
    def total(rows: pa.Table) -> pa.Table:
        parts = rows.to_pylist()
        own = next(r for r in parts if r["words"] or r["other"])
        n = np.frombuffer(own["words"], "<i8")
        sums = n * unseen
        for r in parts:
            if r["docs"]:
                sums[np.frombuffer(r["docs"], "<u2")] += np.frombuffer(r["sums"], "<f4")
        other = pa.ipc.open_stream(own["other"]).read_all()
        return other.append_column(words, pa.array(n)).append_column(bits, pa.array(np.where(n > 0, -sums, 0.0)))

    return total


def with_loss(docs: DataFrame, model: Model, text_col: str = "text", words: str = "n_words", bits: str = "bits") -> DataFrame:
    """The columns of docs but the text, and two more: number of words and total log2 loss. Their names must be new."""
    sc, other = docs.sparkSession.sparkContext, [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    schema = docs.select(*other, F.lit(0).cast("long").alias(words), F.lit(0.0).alias(bits)).schema
    names, slots = sc.broadcast(model.names), model.slots
    answer = _answer(names, sc.broadcast(model.before), model.discounts, model.total, model.unseen)
    chunks = docs.mapInArrow(_chunks(names, slots, text_col), _CHUNK_SCHEMA)
    sums = chunks.repartition(2 * slots, "slot").groupBy("slot").cogroup(model.table.groupBy("slot")).applyInArrow(answer, _ANSWER_SCHEMA)
    unseen = float(np.log2(model.unseen)) if model.unseen else 0.0
    return sums.groupBy("chunk").applyInArrow(_total(words, bits, unseen), schema)


def trusted_ids(labels: DataFrame, half: int, label_id: str = "doc_id") -> DataFrame:
    """doc_id of trusted documents: half 0 may be trained on, half 1 sets the limits."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    side = F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id")), F.lit(2))
    ids = labels.where(good).select(F.col(label_id).cast("long").alias("doc_id"))
    return ids.where(F.col("doc_id").isNotNull() & (side == half)).distinct()


@dataclass
class Judge:
    model: Model | None
    limits: dict[str, tuple[float, float]]  # language -> mean and highest bits a word; "" for all


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_id: str = "doc_id") -> tuple[Judge, DataFrame]:
    """The judge, and doc_id, lang, n_words, bits and the text's fingerprint (print_a, print_b) of all documents."""
    package_reachable(docs.sparkSession)
    plain = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    model = train(id_and_text(semi_join(plain, trusted_ids(labels, 0, label_id), "doc_id")), _text_bytes(plain))
    scores = written(with_loss(plain.select("*", *_prints("text")), model), "kn-scores")
    unseen = scores.where("n_words > 0").join(trusted_ids(labels, 1, label_id), "doc_id", "left_semi")
    totals = unseen.groupBy("lang").agg(F.sum("bits").alias("bits"), F.sum("n_words").alias("words"), F.count(F.lit(1)).alias("n")).collect()
    if not model.entries or not totals:
        return Judge(None, {}), scores
    mean = {r["lang"]: r["bits"] / r["words"] for r in totals if r["n"] >= LEAST_TRUSTED and r["lang"]}
    mean[""] = sum(r["bits"] for r in totals) / sum(r["words"] for r in totals)
    quantile = F.percentile_approx("drawn", HIGH, 10_000).alias("q")
    drawn = unseen.select("lang", _drawn(_by_language(mean)).alias("drawn"))
    high = {r["lang"]: r["q"] for r in drawn.groupBy("lang").agg(quantile).collect()} | {"": drawn.agg(quantile).first()["q"]}
    return Judge(model, {k: (m, high[k] + MARGIN_BITS) for k, m in mean.items()}), scores


def _by_language(values: dict[str, float], lang: str = "lang"):
    """values[lang], or values[""] for a language without one; a handful of languages."""
    out = F.lit(values[""])
    for name, v in values.items():
        if name:
            out = F.when(F.col(lang) == name, F.lit(v)).otherwise(out)
    return out


def _drawn(mean, words: str = "n_words", bits: str = "bits"):
    return F.when(F.col(words) > 0, (F.col(bits) + F.lit(PRIOR_WORDS) * mean) / (F.col(words) + F.lit(PRIOR_WORDS)))


def _prints(text: str):
    """128 bits of a text, as two numbers; a null text counts as empty."""
    return [F.xxhash64(F.lit(name), F.coalesce(F.col(text).cast("string"), F.lit(""))).alias(name) for name in ("print_a", "print_b")]


def verdict(judge: Judge, words: str = "n_words", bits: str = "bits", lang: str = "lang"):
    """Columns drawn, high and kept of scored documents."""
    if judge.model is None:
        nothing = F.lit(None).cast("double")
        return nothing.alias("drawn"), nothing.alias("high"), F.lit(True).alias("kept")
    mean, high = (_by_language({n: v[k] for n, v in judge.limits.items()}, lang) for k in (0, 1))
    drawn = _drawn(mean, words, bits)
    return drawn.alias("drawn"), high.alias("high"), F.coalesce(drawn <= high, F.lit(True)).alias("kept")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_words, perplexity, drawn_bits, high_bits, kept of every row."""
    judge, scores = fit(docs, labels)
    drawn, high, kept = verdict(judge)
    return scores.select(
        "doc_id",
        F.nullif(F.col("lang"), F.lit("")).alias("lang"),
        "n_words",
        F.when(F.col("n_words") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("n_words"))).alias("perplexity"),
        drawn.alias("drawn_bits"),
        high.alias("high_bits"),
        kept,
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are kept, with all their columns. What is rejected depends on text and language alone: rows are told
    by the text's fingerprint, by broadcast while ``BROADCAST_ROWS`` are rejected at most, else by a shuffle join."""
    judge, scores = fit(docs, labels)
    if judge.model is None:
        return docs
    names = ["_kn_a", "_kn_b", "_kn_lang"]
    rejected = scores.where(~verdict(judge)[2]).select(*[F.col(c).alias(n) for c, n in zip(("print_a", "print_b", "lang"), names)])
    rejected = written(rejected.distinct(), "kn-rejected")
    few = rejected.count() <= BROADCAST_ROWS
    own = [*_prints("text"), F.coalesce(F.col("lang").cast("string"), F.lit(""))]
    same = (own[0] == F.col(names[0])) & (own[1] == F.col(names[1])) & (own[2] == F.col(names[2]))
    return docs.join(F.broadcast(rejected) if few else rejected, same, "left_anti")
