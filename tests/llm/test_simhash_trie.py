import random

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from awkward import prose
from merchantlake.llm import simhash_trie as S
from merchantlake.llm.components import components
from merchantlake.llm.xxh64 import xxh64_slices


def fingerprint(text, size=3):
    lowered = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "")
    words = [w for w in lowered.replace("\x1c", "\x00").encode().split() if w]
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows):
    """(doc_id, text) to (doc_id, fingerprint, component)."""
    prints = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    out = []
    for k, (d, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if label[m] == label[k] and rows[m][0] is not None]
        out.append((d, f"{prints[k]:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def test_slices_hash_as_the_library_does():
    r = random.Random(1)
    data = r.randbytes(3000)
    starts = np.array([r.randrange(2500) for _ in range(500)])
    lengths = np.array([r.choice([0, 1, 3, 4, 7, 8, 31, 32, 33, 64, 200]) for _ in range(500)])
    expected = [xxhash.xxh64_intdigest(data[s : s + n], seed=42) for s, n in zip(starts, lengths)]
    assert xxh64_slices(data, starts, lengths, 42).tolist() == expected


def test_equals_brute_force(spark, rows):
    r = random.Random(5)
    texts = [prose(k, r.randint(0, 50)) for k in range(40)]
    texts += [t.replace("a", "b", 1) for t in texts[:20]] + [t.upper() for t in texts[:5]] + ["x" * 100 + " y z", "one two"]
    given = [(k * 3, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    assert rows(S.simhash_components(docs)) == brute(given)


def test_awkward_rows(awkward, rows):
    given = [(x.doc_id, x.text) for x in awkward.select("doc_id", "text").collect()]
    assert rows(S.simhash_components(awkward)) == brute(given)


def test_no_documents(no_documents):
    assert S.simhash_components(no_documents).count() == 0
    assert S.near_duplicates_removed(no_documents).count() == 0


def test_one_of_each_group_stays(awkward):
    kept = S.near_duplicates_removed(awkward)
    assert kept.columns == awkward.columns
    ids = [x.doc_id for x in kept.collect()]
    assert ids.count(5) == 1 and 13 in ids and 14 not in ids and 6 in ids


@pytest.mark.parametrize("area", [0, 4, 10_000])
def test_trie_matches_all_pairs_within_the_budget(monkeypatch, area):
    monkeypatch.setattr(S, "SMALL_AREA", area)
    r = np.random.default_rng(2)
    centres = r.integers(0, 1 << 63, 20, dtype=np.uint64)
    near = np.concatenate([c ^ (np.uint64(1) << r.integers(0, 64, 15, dtype=np.uint64)) for c in centres])
    a = np.unique(np.concatenate([centres, near, r.integers(0, 1 << 63, 200, dtype=np.uint64)]))
    b = np.unique(np.concatenate([near ^ np.uint64(5), centres]))

    def found(x, y, same):
        return {(int(i), int(j)) for p, q in S.trie_matches(x, y, 3, same) for i, j in zip(p, q)}

    distance = lambda x, y: np.bitwise_count(x[:, None] ^ y[None, :]) <= 3
    assert found(a, a, True) == {(i, j) for i, j in zip(*np.nonzero(distance(a, a))) if i < j}
    assert found(a, b, False) == set(map(tuple, np.argwhere(distance(a, b)).tolist()))


def test_leaves_cover_every_pair_within_the_budget():
    r = random.Random(7)
    counts = {r.randrange(1 << 16) if r.random() < 0.5 else r.randrange(64): r.randint(1, 50) for _ in range(3000)}
    nodes = S._cut(counts, 500)
    leaves = [n for n, leaf in nodes.items() if leaf]
    assert all(sum(n for p, n in counts.items() if p >> (16 - d) == x) <= 500 or d == 16 for d, x in leaves)
    pairs = {frozenset(p) for p in S._leaf_pairs(nodes, 3)}
    assert pairs == {frozenset((a, b)) for a in leaves for b in leaves if S._differing(a, b) <= 3}


def test_components_of_chains_stars_and_cycles(spark):
    r = random.Random(9)
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, 100 + k) for k in range(1, 300)]
    cycle = [(500 + k, 500 + (k + 1) % 9) for k in range(9)]
    loose = [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(200)]
    edges = chain + star + cycle + loose + [(7, 7)]
    r.shuffle(edges)
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        before = dict(label)
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == label


def shingles(text, size=5):
    words = text.split()
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def test_similar_texts_are_linked_and_others_are_not(spark):
    """Copies with ever more words replaced: those over the similarity stay together, far ones stay apart."""
    r = random.Random(11)
    texts, wanted = [], []
    for group in range(60):
        base = prose(1000 + group, 200).split()
        for changed in (0, 1, 2, 3, 40):
            words = list(base)
            for at in r.sample(range(len(words)), changed):
                words[at] = f"new{r.randrange(10**6)}"
            a, b = shingles(" ".join(base)), shingles(" ".join(words))
            wanted.append((group, len(a & b) / len(a | b)))
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {x.doc_id: x.component_id for x in S.similar_components(docs).collect()}
    close = [(k, 5 * group) for k, (group, j) in enumerate(wanted) if j >= 0.85]
    far = [(k, 5 * group) for k, (group, j) in enumerate(wanted) if j <= 0.5]
    assert len(close) > 150 and len(far) > 50
    assert sum(got[k] == first for k, first in close) >= 0.99 * len(close)
    assert all(got[k] != first for k, first in far)
    assert all(wanted[k][0] == wanted[got[k]][0] for k in got)


def test_allowed_bits_grow_as_similarity_falls():
    assert S.allowed_bits(1.0) == 0 < S.allowed_bits(0.9) < S.allowed_bits(0.8) < S.allowed_bits(0.5) < 160


def shingle_set(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_similar_texts_equal_brute_force_about_the_threshold(spark):
    """Pairs at exactly 0.8, just below it, and of half their shingles: joined and left apart by their shingles alone."""
    given = []
    for k in range(150):
        n = (12, 40, 120)[k % 3]  # shingles of the whole text
        words = [f"w{k}x{i}" for i in range(n + 4)]
        # Without its last fifth of shingles a text has exactly 0.8 of them; one word less is below.
        cut = {0: n // 5, 1: n // 5 + 1, 2: n // 2}[k // 3 % 3] if n % 5 == 0 else {0: 2, 1: 3, 2: 6}[k // 3 % 3]
        given += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[: len(words) - cut]))]
    sets = [shingle_set(t) for _, t in given]
    near = {k for k in range(0, 300, 2) if len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1]) >= 0.8}
    assert sum(len(sets[k + 1]) * 5 == len(sets[k]) * 4 for k in near) >= 30 and len(near) < 60
    got = {x.doc_id: x.component_id for x in S.similar_components(spark.createDataFrame(given, "doc_id bigint, text string")).collect()}
    assert {k for k in range(0, 300, 2) if got[k + 1] == k} == near
    assert all(got[k] == k and got[k + 1] in (k, k + 1) for k in range(0, 300, 2))


def test_similar_families_equal_brute_force(spark):
    """Families whose members are similar to some only, so that links have to be found beside the smallest node's."""
    r = random.Random(8)
    given = []
    for family in range(6):
        words = [f"f{family}x{i}" for i in range(64)]
        for _ in range(15):
            given.append((len(given), " ".join(words)))
            if r.random() < 0.7:
                words = list(words)
                words[r.randrange(64)] = f"n{len(given)}"
    sets = [shingle_set(t) for _, t in given]
    label = list(range(len(given)))
    for i in range(len(given)):
        for j in range(i):
            if label[i] != label[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    got = {x.doc_id: x.component_id for x in S.similar_components(spark.createDataFrame(given, "doc_id bigint, text string")).collect()}
    assert [got[k] for k in range(len(given))] == label


def test_an_id_of_texts_in_two_components_keeps_only_the_one_it_names(spark):
    base, other = prose(1, 60), prose(2, 60)
    docs = spark.createDataFrame([(3, base), (6, other), (6, base + " word"), (7, other + " more")], "doc_id bigint, text string")
    kept = S.near_duplicates_removed(docs)
    assert sorted(map(tuple, kept.collect())) == [(3, base), (6, other)]


def test_the_stage_keeps_what_fingerprints_name(spark, awkward):
    """One row for each component of fingerprints, by brute force, and none that only shingles would join."""
    r = random.Random(12)
    texts = [prose(k, r.randint(1, 80)) for k in range(30)]
    texts += [t + " more" for t in texts] + [t.upper() for t in texts[:9]]
    given = list(enumerate(texts))
    docs = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    kept = corpus_pipeline.by_near_duplicates(spark, docs, "")
    expected = sorted(d for d, _, component in brute(given) if d == component)
    assert sorted(x.doc_id for x in kept.collect()) == expected and 30 < len(expected) < 60
    odd = [(x.doc_id, x.text) for x in awkward.select("doc_id", "text").collect()]
    named = {d for d, _, component in brute(odd) if d is not None and d == component}
    left = [(x.doc_id, x.text) for x in corpus_pipeline.by_near_duplicates(spark, awkward, "").collect()]
    assert {x[0] for x in left if x[0] is not None} == named and len(set(left)) == len(left)
