"""Operator 10: word-piece lengths of whole texts by a linear longest-match automaton.

A text is cut into words at white space; each word, with one blank before it, is matched against the
vocabulary from the left, always taking the longest piece. Only the number of pieces is made. The
vocabulary is a trie whose nodes have a failure link (where matching goes on when the next byte has no
edge) and the number of pieces that taking that link pops, both worked out beforehand; a word of n
bytes then takes O(n) steps, however often a longer match fails. A byte that is no piece of the
vocabulary counts as a piece of its own, so each word has a length.

Null and empty texts have 0 words and 0 tokens; repeated rows are counted each; other columns are not
read. There is no shuffle: each task holds the automaton (bounded by the vocabulary) and one slice of
text.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm import arrays as A
from flowlens.llm.common import id_and_text

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
REMEMBERED_WORDS = 400_000


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """Pieces of a vocabulary file with one base64 piece and its rank a line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Automaton:
    """Trie, failure links and pop counts as arrays; state 0 is the root."""

    def __init__(self, pieces: Iterable[bytes]):
        edges: list[dict[int, int]] = [{}]
        is_piece = [False]
        for piece in {bytes([b]) for b in range(256)} | set(pieces):
            state = 0
            for b in piece:
                if b not in edges[state]:
                    edges[state][b] = len(edges)
                    edges.append({})
                    is_piece.append(False)
                state = edges[state][b]
            is_piece[state] = state > 0
        n = len(edges)
        link, pops = np.full(n, -1, np.int32), np.zeros(n, np.int32)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for b, v in edges[u].items():
                queue.append(v)
                if is_piece[v]:
                    link[v], pops[v] = 0, 1
                    continue
                z, popped = int(link[u]), int(pops[u])
                while z >= 0 and b not in edges[z]:
                    popped += int(pops[z])
                    z = int(link[z])
                link[v], pops[v] = edges[z][b], popped
        rest = np.zeros(n, np.int64)  # pieces still to pop when a word ends in a state
        queue = deque([0])
        while queue:
            u = queue.popleft()
            queue.extend(edges[u].values())
            z = u
            while z:
                rest[u] += pops[z]
                z = int(link[z])
        key = np.array([u << 8 | b for u, out in enumerate(edges) for b in out], np.int64)
        to = np.array([v for out in edges for v in out.values()], np.int32)
        order = np.argsort(key)
        self.key, self.to, self.link, self.pops, self.rest = key[order], to[order], link, pops, rest

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next state and pieces popped on the way, for many states at once."""
        out, popped = np.empty(len(state), np.int32), np.zeros(len(state), np.int64)
        left = np.arange(len(state))
        while len(left):
            want = state[left].astype(np.int64) << 8 | byte[left]
            at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[at] == want
            out[left[hit]] = self.to[at[hit]]
            left = left[~hit]
            popped[left] += self.pops[state[left]]
            state[left] = self.link[state[left]]
        return out, popped

    def lengths(self, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Number of pieces of a blank and each span of data."""
        order = np.argsort(first - last, kind="stable")  # longest first: those still read are a prefix
        first, size = first[order], (last - first)[order]
        state, count = np.zeros(len(first), np.int32), np.zeros(len(first), np.int64)
        state[:], _ = self.step(state, np.full(len(first), 0x20, np.uint8))
        live = len(first)
        for j in range(int(size[0]) if len(size) else 0):
            while live and size[live - 1] <= j:
                live -= 1
            state[:live], popped = self.step(state[:live], data[first[:live] + j])
            count[:live] += popped
        out = np.empty(len(first), np.int64)
        out[order] = count + self.rest[state]
        return out


class WordCounter:
    """Piece counts of words; those of frequent words are kept by hash, up to a fixed number."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.seen, self.known = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def counts(self, data, first, last, h) -> np.ndarray:
        unique, where, back = np.unique(h, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.seen, unique), max(len(self.seen) - 1, 0))
        hit = self.seen[at] == unique if len(self.seen) else np.zeros(len(unique), bool)
        pieces = np.empty(len(unique), np.int64)
        pieces[hit] = self.known[at[hit]]
        new = where[~hit]
        pieces[~hit] = self.automaton.lengths(data, first[new], last[new])
        if len(self.seen) < REMEMBERED_WORDS and len(new):
            seen, known = np.concatenate((self.seen, unique[~hit])), np.concatenate((self.known, pieces[~hit]))
            order = np.argsort(seen)
            self.seen, self.known = seen[order], known[order]
        return pieces[back]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Automaton(read_vocabulary(vocabulary)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounter(shared.value)
        for part in A.slices(batches):
            data, offsets = A.bytes_of(part.column(1))
            first, last, h, starts = A.words(data, offsets, lower=False)
            total = np.concatenate(([0], np.cumsum(counter.counts(data, first, last, h))))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(starts)), pa.array(total[starts[1:]] - total[starts[:-1]])],
                ["doc_id", "n_words", "n_tokens"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(count, "doc_id long, n_words long, n_tokens long")
