import hashlib
import random

import numpy as np
import pytest

from awkward import prose
from merchantlake.llm import suffix_dedup as S
from merchantlake.llm.interleave import later_windows, merge

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(texts: list[str | None]) -> list[tuple]:
    """Texts in corpus order: every string of 100 bytes that was seen before is removed."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        covered = np.zeros(len(raw) + 1, dtype=bool)
        own = []
        for p in range(len(raw) - 99):
            window = raw[p : p + 100]
            if window in seen:
                covered[p : p + 100] = True
            seen.add(window)
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        edges = np.diff(covered.astype(int), prepend=0)
        out.append((len(raw), int(covered.sum()), int((edges > 0).sum()), hashlib.sha256(kept).hexdigest(), own)[:4])
    return out


def pieces(seed: int, n: int) -> list[str]:
    """Texts stitched from a few passages, with changed letters."""
    r = random.Random(seed)
    passages = [prose(seed * 1000 + k, r.randint(5, 60)) for k in range(8)]
    texts = []
    for _ in range(n):
        text = " ".join(r.choice(passages) for _ in range(r.randint(0, 6)))
        for _ in range(r.randint(0, 3)):
            if text:
                at = r.randrange(len(text))
                text = text[:at] + r.choice("xyzé") + text[at + 1 :]
        texts.append(text)
    return texts


@pytest.mark.parametrize("seed, most", [(1, 2000), (2, 2), (3, 2000)])
def test_equals_brute_force(spark, rows, monkeypatch, seed, most):
    monkeypatch.setattr(S, "MAX_CONTEXTS", most)
    texts = pieces(seed, 40) + ["ab" * 300, "ab" * 200 + "c", "é" * 150]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    expected = sorted(((k, *r) for k, r in enumerate(brute(texts))), key=repr)
    assert rows(S.suffix_dedup(docs), *COLUMNS) == expected


def test_awkward_rows(awkward, rows):
    got = S.suffix_dedup(awkward, others=("source", "document"))
    assert got.count() == awkward.count()
    keyed = {}
    for r in got.collect():
        keyed.setdefault((r.doc_id, r.n_bytes), set()).add((r.n_removed, r.n_spans, r.kept_sha256))
    assert all(len(v) == 1 for v in keyed.values())  # rows that repeat a document agree
    by_id = {r.doc_id: r for r in got.where("doc_id in (5, 8, 9, 11, 14)").collect()}
    assert by_id[5].n_removed == 0 and by_id[8].n_bytes == 0 == by_id[9].n_bytes and by_id[11].n_removed == 0
    assert by_id[14].n_removed == by_id[14].n_bytes - len("~end")
    nulls = {r.n_bytes: r.n_removed for r in got.where("doc_id is null").collect()}
    assert all(removed == n for n, removed in nulls.items())  # the last of all: its text was there before


def test_no_documents(no_documents):
    assert S.suffix_dedup(no_documents).count() == 0


def test_pieces_of_a_long_text_cover_it():
    text = prose(5, 250_000)
    assert len(text.encode()) > S.BLOCK
    places = [p for portion in S._pieces([text]) for p in portion]
    starts = [s for _, offset, piece in places for s in (offset, offset + len(piece) - S.LENGTH)]
    assert starts[0] == 0 and starts[-1] == len(text.encode()) - S.LENGTH
    assert all(b - a == 1 for a, b in zip(starts[1:-1:2], starts[2:-1:2]))


def test_merge_orders_all_rotations_and_common_prefixes():
    r = random.Random(3)
    strings = list({bytes(r.choice(b"ab") for _ in range(r.randint(1, 30))) for _ in range(40)})
    owner, offset, common = merge(strings, np.arange(len(strings)) // 7, 50)
    closed = [s + b"\xff" for s in strings]
    rotations = [closed[o][k:] + closed[o][:k] for o, k in zip(owner, offset)]
    endless = [(x * 70)[:70] for x in rotations]  # rotations of different lengths compare as they go round
    assert endless == sorted(endless) and len(rotations) == sum(map(len, closed))

    def shared(a, b):
        return next((k for k in range(50) if a[k % len(a)] != b[k % len(b)]), 50)

    assert list(common[1:]) == [shared(a, b) for a, b in zip(rotations, rotations[1:])]


def test_later_windows_looks_only_at_whole_windows():
    strings = [b"xxabcdef", b"yabcdefz", b"abcdq"]
    windows = np.array([len(s) - 4 + 1 for s in strings])
    found = {tuple(x) for x in later_windows(strings, windows, np.array([0, 1, 1]), 4).tolist()}
    assert found == {(1, 1), (1, 2), (1, 3), (2, 0)}


def common_line() -> str:
    """Of many lines, the one whose hash is least: it is the anchor of nearly all strings around it."""
    r = random.Random(8)
    lines = ["".join(r.choice("abcdefgh ") for _ in range(S.GRAM)) for _ in range(20_000)]
    data = np.frombuffer("".join(lines).encode(), dtype=np.uint8)
    begins = np.arange(len(lines)) * S.GRAM
    return lines[int(S._mix(S._Hashed(data, 0)(begins, begins + S.GRAM)).argmin())]


def test_many_long_contexts_of_one_anchor(spark, rows, monkeypatch):
    """Their strings are hashed in portions that the powers reach, however long the contexts are."""
    monkeypatch.setattr(S, "MAX_CONTEXTS", 50)
    r, line = random.Random(9), common_line()
    sides = ["".join(r.choice("abcdefgh ") for _ in range(85)) for _ in range(3600)]
    texts = [sides[k % 3000] + line + sides[-k] for k in range(3600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    expected = sorted(((k, *x) for k, x in enumerate(brute(texts))), key=repr)
    assert sum(x[2] > 0 for x in expected) >= 600
    assert rows(S.suffix_dedup(docs), *COLUMNS) == expected
