"""Documents with known copies, and plain Python helpers that the brute-force versions share."""

import random
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None, low: bool = True) -> list[bytes]:
    return WORD.findall((lower(text) if low else text or "").encode())


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ba", "re", "ti", "ón", "st", "ü"]) for _ in range(rng.randint(1, 5))) for _ in range(n))


_BASE = prose(1, 120)
_NEAR = " ".join(_BASE.split()[:118] + ["changed", "end"])
_LONG = prose(2, 60_000)
EDGE_ROWS = [
    (1, _BASE, "en"),
    (2, _BASE.replace(" ", "\n\t"), "en"),
    (3, _NEAR, "en"),
    (4, None, "en"),
    (5, "", None),
    (6, " \t\n\x0b\x0c\r ", "de"),
    (7, "One", "fr"),
    (8, "one", "fr"),
    (9, "a b c d", "es"),
    (10, "A  B\nC d", None),
    (11, "12 34 -- !!", "en"),
    (12, _LONG, "de"),
    (12, _LONG, "de"),
    (13, "ééé ñ 漢字 😀  x", "fr"),
    (None, _BASE, "en"),
    (None, None, None),
    (14, prose(3, 80) + "\n" + prose(4, 60) + "\n" + prose(5, 10), "en"),
    (15, prose(6, 30) + "\n" + prose(4, 60), "en"),
    (16, prose(7, 40) + " " + prose(4, 60) + " " + prose(8, 40), "en"),
]
