"""Periodic runs (13) against brute force over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from flowlens.llm import periodic as P
from flowlens.llm.queries import QUERIES
from tests.llm.cases import EDGE_ROWS, words


def brute_runs(text):
    """(start, length, period) of all runs of a list of words."""
    n, out = len(text), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if text[i] != text[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and text[j] == text[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(all(text[k] == text[k + d] for k in range(i, j + q - d)) for d in range(1, q)):
                out.add((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text, alter=True):
    w = words(text, low=False)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if alter and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    collapsed = b" ".join(x for k, x in enumerate(w) if k not in gone)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())


def by_slice(texts):
    """Runs of each of the texts (lists of words), worked out in one slice."""
    names = {}
    word = np.array([names.setdefault(w, len(names)) for t in texts for w in t], np.uint64)
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    out = [[] for _ in texts]
    for a, b, p in zip(*(x.tolist() for x in P.runs(P.A.mix(word), starts))):
        i = int(np.searchsorted(starts, a, "right")) - 1
        out[i].append((a - starts[i], b - a, p))
    return out


def test_runs_of_made_texts():
    rng = random.Random(5)

    def text():
        out = []
        for _ in range(rng.randint(0, 6)):
            unit = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
            out += unit * rng.randint(1, 7) + unit[: rng.randint(0, len(unit))]
            out += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 6))]
        return out

    for _ in range(60):
        texts = [text() for _ in range(8)]
        assert by_slice(texts) == [brute_runs(t) for t in texts]


def test_runs_of_two_words_only():
    rng = random.Random(6)
    texts = [[rng.choice("ab") for _ in range(rng.randint(0, 40))] for _ in range(300)]
    assert by_slice(texts) == [brute_runs(t) for t in texts]


def test_one_word_many_times_and_nested_periods():
    nested = (["a"] * 8 + ["b"]) * 6
    fib = ["a"], ["a", "b"]
    while len(fib[1]) < 400:
        fib = fib[1], fib[1] + fib[0]
    texts = [["x"] * 5, ["x"] * 6, ["x"] * 1000, nested, fib[1], ["a", "b"] * 3, ["a", "b"] * 4, ["a", "b", "c"] * 4, []]
    got = by_slice(texts)
    assert got == [brute_runs(t) for t in texts]
    assert got[2] == [(0, 1000, 1)] and (0, 54, 9) in got[3] and got[5] == [] and got[6] == [(0, 8, 2)]


def test_hashes_that_agree_are_found_out():
    """Polynomial hashes modulo 2**64 of a Thue-Morse word and its complement are equal; words decide."""
    t = [bin(i).count("1") % 2 for i in range(1 << 12)]
    other = [1 - x for x in t]
    unit = t
    text = ["ab"[x] for x in unit * 4 + other]
    (got,) = by_slice([text])
    assert max(got, key=lambda r: r[1])[2] == 1 << 12
    s, n, q = max(got, key=lambda r: r[1])
    assert all(text[k] == text[k + q] for k in range(s, s + n - q))
    assert s + n == len(text) or text[s + n] != text[s + n - q]


def test_range_successor():
    rng = np.random.default_rng(3)
    values = rng.permutation(300)
    tree = P.WaveletMatrix(values)
    lo = rng.integers(0, 299, 200)
    hi = lo + 1 + rng.integers(0, 300 - lo)
    x = rng.integers(0, 300, 200)
    below = tree.below(lo, hi, x)
    assert below.tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(lo, hi, x)]
    some = below < hi - lo
    assert tree.quantile(lo[some], hi[some], below[some]).tolist() == [min(v for v in values[a:b] if v >= c) for a, b, c in zip(lo[some], hi[some], x[some])]


def test_query_against_brute_force(spark, small):
    got = {tuple(r) for r in QUERIES["op13_periodic_runs"](spark, small).collect()}
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id for r in rows if len(r.text) < 12_000}
    assert len(got) == len(rows) and len(short) > 150
    assert {r for r in got if r[0] in short} == {brute_digest(r.doc_id, r.text) for r in rows if r.doc_id in short}
    assert sum(r[1] > 0 for r in got) >= 10


def test_edges(spark, edge_docs, no_docs):
    repeat = "a b\n a\tb a b a b é"
    more = spark.createDataFrame([(100, repeat), (100, repeat), (None, repeat), (101, "w " * 30_000)], "doc_id long, text string")
    docs = edge_docs.select("doc_id", "text").union(more)
    got = [tuple(r) for r in P.run_digests(docs, alter=P.planted).collect()]
    rows = [(i, t) for i, t, _ in EDGE_ROWS if t is None or len(t) < 100_000] + [(100, repeat), (100, repeat), (None, repeat)]
    want = [brute_digest(i, t) for i, t in rows]
    for r in want:
        assert got.count(r) >= want.count(r), r
    assert len(got) == len(EDGE_ROWS) + 4
    assert [r[1:6] for r in got if r[0] == 101] == [(1, 0, 30_000, 1, 30_000_000)]
    empty = hashlib.sha256(b"").hexdigest()
    assert (4, 0, None, None, None, None, empty, empty) in got
    assert [tuple(r) for r in P.periodic_runs(more).where("doc_id = 100").collect()] == [(100, 0, 8, 2)] * 2
    assert {r.doc_id: r.text for r in P.collapsed_texts(more).collect()} == {100: "a b é", None: "a b é", 101: "w"}
    for of in (P.run_digests, P.periodic_runs, P.collapsed_texts):
        assert of(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_planted_places(n):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert ids and P.planted(0, ids[0]) is None and P.planted(n, None) is None
    for i in ids:
        g = zlib.crc32(str(i).encode()) // 10
        a, out = g % n, P.planted(n, i)
        p = 1 + (n - a) // (3 + g % 8)
        assert out.tolist() == [k if k < a else a + (k - a) % p for k in range(n)]
