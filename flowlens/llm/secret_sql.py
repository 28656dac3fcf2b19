"""The DuckDB twin of operator 12: matches and the pieces between them give places, list lambdas give checksums."""

from __future__ import annotations

_ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_CARD = r"""(?:[cC][aA][rR][dD]|[pP][aA][nN])[\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]{1,3}([0-9](?:[\x20-]?[0-9])+)"""

#: kind, pattern, the group whose text the rule reads, the rule
_KINDS = [
    ("assign", _ASSIGN, 2, "length(part) >= 6"),
    ("access", "AKIA[A-Z0-9]+", 0, "length(part) >= 20"),
    ("hex", "[0-9a-f]+", 0, "length(part) >= 24"),
    ("checked", "(?:gh[pousr]|npm)_[A-Za-z0-9]+", 0, "length(part) = 40 AND substr(part, 35) = base62"),
    ("card", _CARD, 1, "length(digits) BETWEEN 13 AND 19 AND luhn % 10 = 0"),
]

_FOUND = "\n UNION ALL ".join(
    f"SELECT row_id, {n} AS kind, '{kind}' AS name, regexp_split_to_array(text, '{pattern}') AS pieces,"
    f" regexp_extract_all(text, '{pattern}', 0) AS whole, regexp_extract_all(text, '{pattern}', {group}) AS parts FROM d"
    for n, (kind, pattern, group, _) in enumerate(_KINDS)
)
_RULE = " ".join(f"WHEN {n} THEN {rule}" for n, (_, _, _, rule) in enumerate(_KINDS))

SECRETS_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
found AS ({_FOUND}),
each AS (
  SELECT row_id, kind, name, parts[k] AS part, length(whole[k]) AS size,
         coalesce(list_sum(list_transform(pieces[:k], lambda p: length(p))), 0)
           + coalesce(list_sum(list_transform(whole[:k - 1], lambda w: length(w))), 0) AS place
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS k FROM found WHERE len(whole) > 0)),
summed AS (
  SELECT each.*, regexp_replace(part, '[ -]', '', 'g') AS digits,
         CASE WHEN kind = 3 AND length(part) = 40 THEN xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(range(5, 35), lambda i: ascii(substr(part, i, 1))::BIGINT)),
           lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8))) END AS sum32
  FROM each, crc),
checked AS (
  SELECT *,
         array_to_string(list_transform(range(6), lambda i: substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz',
           ((sum32 // (62 ** (5 - i))::BIGINT) % 62)::BIGINT + 1, 1)), '') AS base62,
         CASE WHEN kind = 4 THEN list_sum(list_transform(range(length(digits)), lambda i: CASE
           WHEN i % 2 = 0 THEN substr(digits, length(digits) - i, 1)::INT
           ELSE 2 * substr(digits, length(digits) - i, 1)::INT - CASE WHEN substr(digits, length(digits) - i, 1)::INT > 4 THEN 9 ELSE 0 END END)) END AS luhn
  FROM summed),
spans AS (
  SELECT row_id, kind, name, place::BIGINT AS place, name || ':' || place::BIGINT || ':' || (place + size)::BIGINT AS span
  FROM checked WHERE CASE kind {_RULE} END),
by_row AS (
  SELECT row_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(span, ',' ORDER BY place, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY place, kind) AS spans
  FROM spans GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN by_row USING (row_id)"""
