"""Words, n-grams and slices of the numpy helper against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from flowlens.llm import arrays as A
from tests.llm.cases import words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\né漢\r\x0b!", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    data, offsets = A.bytes_of(pa.array(texts, pa.string()))
    first, last, h, starts = A.words(data, offsets)
    got = [[bytes(A.LOWER[data[a:b]]) for a, b in zip(first[i:j], last[i:j])] for i, j in zip(starts[:-1], starts[1:])]
    assert got == [words(t) for t in texts]
    flat = [w for t in got for w in t]
    assert len(set(h.tolist())) == len(set(flat))
    assert len({(w, x) for w, x in zip(flat, h.tolist())}) == len(set(flat))


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_ngrams_stay_in_their_row(texts, n):
    data, offsets = A.bytes_of(pa.array(texts, pa.string()))
    _, _, h, starts = A.words(data, offsets)
    grams, first = A.ngrams(h, starts, n)
    want = [[tuple(w[k : k + n]) for k in range(len(w) - n + 1)] for w in map(words, texts)]
    assert np.diff(first).tolist() == [len(w) for w in want]
    flat = [g for w in want for g in w]
    assert len({(g, x) for g, x in zip(flat, grams.tolist())}) == len(set(flat)) == len(set(grams.tolist()))


def test_hash_does_not_depend_on_the_place():
    texts = ["same word", "x" * 5000 + " word", None, "word"]
    data, offsets = A.bytes_of(pa.array(texts))
    _, _, h, _ = A.words(data, offsets)
    assert h[1] == h[3] == h[4]


def test_long_text_hashes_like_its_pieces(monkeypatch):
    text = " ".join(f"w{i % 701}" for i in range(5000))
    data, offsets = A.bytes_of(pa.array([text]))
    whole = A.words(data, offsets)[2]
    monkeypatch.setattr(A, "SLICE_BYTES", 256)
    assert (A.words(data, offsets)[2] == whole).all()


def test_slices_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(["ab" * 9, None, "", "c" * 50, "d", "e" * 3, "", "f", "g" * 99])], ["id", "text"])
    got = list(A.slices([batch.slice(0, 0), batch], limit=20))
    assert [i for b in got for i in b.column(0).to_pylist()] == list(range(9))
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column(1).to_pylist()) <= 20 for b in got)
