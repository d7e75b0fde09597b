"""Documents that are awkward in every way an operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ("id", "th", "h", "c", "w", "t", "size", "hash", "target", "document", "fp", "kept", "n_words", "held_out", "score", "item", "record")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéfgh") for _ in range(r.randint(2, 8))) for _ in range(n))


def awkward_rows() -> list[tuple]:
    shared = prose(1, 60)
    long = " ".join(prose(100 + k, 400) for k in range(40)) + " " + shared
    rows = [
        (5, shared, "en", "a", 1),
        (5, shared, "en", "a", 1),
        (6, shared, "en", None, 1),
        (6, "other text under the same id " + prose(2, 30), None, "b", 1),
        (7, prose(3, 20) + " " + shared + " " + prose(4, 20), None, "b", None),
        (8, "", "en", "c", 0),
        (9, None, "en", "c", 0),
        (10, " \n\t\x0b ", "de", "c", 4),
        (11, "word", "de", "c", 4),
        (12, "1234 5678 !!", "de", "d", 4),
        (13, long, "de", "d", 4),
        (14, long + "~end", "de", "d", 4),
        (15, "ab" * 400, "de", "d", 4),
        (None, shared, None, None, None),
        (None, None, None, None, None),
        (-3, "é" * 150, "fr", "d", 4),
        (16, "ÀB C\rD\x0cE 😀 " * 12, "fr", "z", 4),
    ]
    return rows
