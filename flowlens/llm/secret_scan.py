"""Operator 12: secrets in texts, by a keyword automaton, anchored patterns near its hits, and checksums.

An Aho-Corasick automaton over all keywords passes each slice of texts once (A-Z lower-cased). Only where a
keyword stands, the pattern of its kind is matched, anchored at that place and bounded by the text's end; a hit
inside the kind's last match is passed over. As every match of a kind begins with one of its keywords, this gives
the pattern's leftmost matches that don't overlap. Kinds, with the rule that a match has to meet, else it is dropped:

* ``assign``: a name such as password or api_key, a sign, and a value of 6 characters or more;
* ``access``: AKIA and capitals or digits, 20 characters or more;
* ``hex``: a whole run of 24 or more of 0-9a-f; its keywords are all 4-digit hexadecimal numbers, so the run's own
  beginning is a hit;
* ``checked``: a prefixed token whose last six characters are the base-62 CRC-32 of the thirty before them;
* ``card``: a card number after the word card or pan, 13 to 19 digits whose Luhn sum is 0 modulo 10.

The first three are patterns alone (base spans); the last two are validated by a checksum that the secret holds
itself, and add to them. Spans are of the whole match, in code points, end exclusive; kinds may overlap.

Texts are scanned whole, in slices of bounded size, so memory follows the longest text; Spark only maps, and a lost
task is done again from its input. A null text counts as empty; empty texts have no spans. Rows are answered one
by one: repeated rows get equal results, a null id stays null. Other columns are not read. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm import arrays as A
from flowlens.llm.common import id_and_text

KINDS = ["assign", "access", "hex", "checked", "card"]
BASE_KINDS = KINDS[:3]
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
    "access": ["akia"],
    "checked": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"],
    "card": ["card", "pan"],
}
PATTERNS = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]+"),
    "checked": re.compile(rb"(?:gh[pousr]|npm)_[A-Za-z0-9]+"),
    "card": re.compile(rb"(?:card|pan)[\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]{1,3}([0-9](?:[\x20-]?[0-9])+)", re.IGNORECASE),
}
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
CARD_DIGITS = range(13, 20)
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_LOWER = bytes(A.LOWER)


def base62_crc(body: bytes) -> bytes:
    """CRC-32 in six digits of base 62."""
    crc, out = zlib.crc32(body), bytearray(6)
    for k in range(5, -1, -1):
        crc, digit = divmod(crc, 62)
        out[k] = _BASE62[digit]
    return bytes(out)


def luhn(digits: bytes) -> bool:
    """Whether the sum of the digits, each second one from the right doubled (and 9 taken off beyond 9), ends in 0."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = c - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _checked(m: re.Match) -> bool:
    token = m.group()
    return len(token) == 40 and token[34:] == base62_crc(token[4:34])


def _card(m: re.Match) -> bool:
    digits = m.group(1).translate(None, b" -")
    return len(digits) in CARD_DIGITS and luhn(digits)


RULES = {
    "assign": lambda m: m.end(2) - m.start(2) >= LEAST_VALUE,
    "access": lambda m: m.end() - m.start() >= LEAST_ACCESS,
    "hex": lambda m: m.end() - m.start() >= LEAST_HEX,
    "checked": _checked,
    "card": _card,
}


@cache
def automaton() -> ahocorasick.Automaton:
    """All keywords; the value of each is its length and the number of its kind. Built once a worker."""
    out = ahocorasick.Automaton()
    for kind, names in KEYWORDS.items():
        for name in names:
            out.add_word(name, (len(name), KINDS.index(kind)))
    for number in range(1 << 16):
        out.add_word(f"{number:04x}", (4, KINDS.index("hex")))
    out.make_automaton()
    return out


def spans(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, kind) of all spans of the texts that lie one after the other in data, in bytes, by start and kind."""
    raw = data.tobytes()
    rules = [(PATTERNS[k], RULES[k]) for k in KINDS]
    done = [0] * len(KINDS)
    at = offsets.tolist()
    text, out = 0, []
    for last, (length, kind) in automaton().iter(raw.translate(_LOWER).decode("latin-1")):
        start = last - length + 1
        if start < done[kind]:
            continue
        while at[text + 1] <= last:
            text += 1
        if start < at[text]:
            continue  # the hit runs over a text's end
        pattern, rule = rules[kind]
        m = pattern.match(raw, start, at[text + 1])
        if m:
            done[kind] = m.end()
            if rule(m):
                out.append((start, m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def _by_text(batches: Iterator[pa.RecordBatch]):
    """Per slice: ids, and for each text its spans (start, end, kind number) in code points, with their bytes."""
    for part in A.slices(batches):
        data, offsets = A.bytes_of(part.column(1))
        found = spans(data, offsets)
        per_text: list[list[tuple[int, int, int, bytes]]] = [[] for _ in range(part.num_rows)]
        if found:
            edges = np.array([s[:2] for s in found])
            point = np.concatenate((np.zeros(1, np.int64), np.cumsum((data & 0xC0) != 0x80)))
            text = np.searchsorted(offsets, edges[:, 0], "right") - 1
            points = point[edges] - point[offsets[text]][:, None]
            for i, (a, b), (start, end, kind) in zip(text.tolist(), points.tolist(), found):
                per_text[i].append((a, b, kind, data[start:end].tobytes()))
        yield part.column(0), per_text


def _span_rows(batches):
    for ids, per_text in _by_text(batches):
        rows = [(i, KINDS[k], a, b, raw.decode()) for i, found in zip(ids.to_pylist(), per_text) for a, b, k, raw in found]
        columns = list(zip(*rows)) if rows else [()] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "kind", "start", "end", "secret"])


DIGEST = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _digest_rows(batches):
    for ids, per_text in _by_text(batches):
        counts, digests, listed = [], [], []
        for found in per_text:
            every = [f"{KINDS[k]}:{a}:{b}" for a, b, k, _ in found]
            base = ",".join(s for s, f in zip(every, found) if f[2] < len(BASE_KINDS))
            counts.append([sum(f[2] == k for f in found) for k in range(len(BASE_KINDS))])
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            listed.append(",".join(every))
        columns = [ids, *(pa.array(c, pa.int64()) for c in zip(*counts)), pa.array(digests, pa.string()), pa.array(listed, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in DIGEST.split(", ")])


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kind, start, end, secret of every span."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_span_rows, "doc_id long, kind string, start long, end long, secret string")


def secret_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base kinds' counts and hash, and all spans (kind:start:end) of every row."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_digest_rows, DIGEST)
