"""Substring dedup against a plain program, and its FM-index against direct comparison."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from awkward import CLASHING, awkward_rows
from merchantlake.llm import substring_dedup as S
from merchantlake.llm.fm_index import FMIndex, WaveletTree

COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def brute(rows):
    """(id, n_words, n_removed, digest) for each (id, text); a null id is later than all others."""
    late = 1 << 70
    split = [(late if d is None else d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in split:
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, d), d)
    out = []
    for (d, w), (given, _) in zip(split, rows):
        gone = np.zeros(len(w), dtype=bool)
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < d:
                gone[i : i + 13] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((given, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def stitched(seed, n):
    """Texts of common passages, whole or cut, with changed words."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") * r.randrange(1, 4)
    passages = [[word() for _ in range(r.randrange(5, 60))] for _ in range(12)]
    texts = []
    for _ in range(n):
        text = []
        for _ in range(r.randrange(0, 5)):
            p = r.choice(passages)
            a = r.randrange(len(p))
            text += p[a : a + r.randrange(1, 60)] + [word() for _ in range(r.randrange(0, 15))]
        for _ in range(r.randrange(0, 3)):
            if text:
                text[r.randrange(len(text))] = "é" + word()
        texts.append("".join(w + r.choice([" ", "\n", "\t ", "\x0b"]) for w in text))
    return texts


def result(docs):
    return S.substring_dedup(docs).select("document.doc_id", *COLUMNS[1:])


@pytest.mark.parametrize("seed, most, piece, shard", [(1, 1 << 14, 1 << 21, 1 << 18), (2, 1, 1 << 21, 1 << 18), (3, 3, 200, 50)])
def test_equals_brute_force(spark, rows, monkeypatch, seed, most, piece, shard):
    """Also with common anchors' windows folded singly, and with texts in small pieces and many small shards."""
    for name, value in (("MAX_CONTEXTS", most), ("PIECE", piece), ("SHARD_WORDS", shard)):
        monkeypatch.setattr(S, name, value)
    given = [*enumerate(stitched(seed, 120)), (130, "ab " * 300), (131, "ab " * 40 + "c"), (7, "ab " * 50), (None, "ab " * 20)]
    docs = spark.createDataFrame(given, "doc_id bigint, text string").repartition(5)
    assert rows(result(docs)) == brute(given)


def test_awkward_rows(spark, awkward, no_documents, rows):
    given = [(r[0], r[1]) for r in awkward_rows()]
    got = S.substring_dedup(awkward)
    assert rows(got.select("document.doc_id", *COLUMNS[1:])) == brute(given)
    assert set(CLASHING) <= set(got.select("document.*").columns)
    assert S.substring_dedup(no_documents).count() == 0


def test_very_long_texts(spark, rows):
    r = random.Random(5)
    long = " ".join(str(r.randrange(10**6)) for _ in range(400_000))
    given = [(1, long), (2, "x" * 3_000_000), (3, "new " + long[1000:200_000] + " end"), (4, " " * 1_000_000), (5, "a " * 300_000)]
    assert rows(result(spark.createDataFrame(given, "doc_id bigint, text string").repartition(3))) == brute(given)


def test_texts_cut_at_white_space_keep_their_words():
    raw = b" ".join(b"%d" % k for k in range(500_000)) + b"\t" + b"y" * (S.PIECE * 2) + b" z"
    assert [w for p in S._pieces(raw) for w in p.split()] == raw.split()


def test_copies_are_dealt_out_evenly(spark):
    """Contexts that many documents share do not gather under their anchors."""
    text = " ".join(str(k * k % 997) for k in range(600))
    docs = spark.createDataFrame([(k, text) for k in range(3000)], "doc_id bigint, text string")
    keyed = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))
    found = keyed.repartition(4).mapInArrow(S._folded, f"{S.KEYS}, again boolean")
    heaviest = found.groupBy("h").count().agg(F.max("count")).first()[0]
    assert heaviest < 0.02 * found.count()


def test_wavelet_tree_counts_symbols():
    rng = np.random.default_rng(2)
    for n, most in ((1, 1), (50, 3), (3000, 700)):
        sequence = np.unique((rng.zipf(1.3, n) % most), return_inverse=True)[1]
        tree = WaveletTree(sequence)
        symbols, at = rng.integers(0, sequence.max() + 1, 400), rng.integers(0, n + 1, 400)
        assert tree.rank(symbols, at).tolist() == [int((sequence[:p] == s).sum()) for s, p in zip(symbols, at)]


def test_wavelet_tree_is_compressed():
    rng = np.random.default_rng(3)
    sequence = np.unique(rng.zipf(1.5, 1 << 16) % 5000, return_inverse=True)[1]
    p = np.bincount(sequence) / len(sequence)
    entropy = -(p * np.log2(p)).sum()
    assert WaveletTree(sequence).bits.words.nbytes * 8 <= len(sequence) * (entropy + 1) + 64


def test_matching_statistics_equal_direct_comparison():
    r = random.Random(7)
    for trial in range(20):
        kinds = r.choice([2, 3, 20])
        sequences = [[r.randrange(kinds) for _ in range(r.randrange(1, 23))] for _ in range(r.randrange(1, 40))]
        sequences += sequences[: len(sequences) // 2] if trial % 2 else []
        words = np.unique([x for s in sequences for x in s], return_inverse=True)[1]
        ends, owners = np.cumsum([len(s) for s in sequences]), np.array([r.randrange(10) for _ in sequences])
        expected = []
        for s, o in zip(sequences, owners):
            for i in range(len(s)):
                earlier = [(q, j) for q, p in zip(sequences, owners) if p < o for j in range(len(q))]
                shared = [next((k for k in range(13) if s[i + k : i + k + 1] != q[j + k : j + k + 1] or i + k >= len(s)), 13) for q, j in earlier]
                expected.append(max(shared, default=0))
        assert FMIndex(words, ends, owners, 13).matching_statistics(words, ends, owners).tolist() == expected
