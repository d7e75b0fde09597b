"""SimHash near-duplicates: a self-join of the binary trie of all fingerprints.

Equal fingerprints are folded first. The trie's upper part is cut into leaves of bounded size from counts by prefix, and
pairs of its nodes are walked together: two subtrees are a task only while their prefixes differ in no more bits than
the budget allows. Each task goes on in the same way, bit by bit, with the pairs that are left, and reports a forest of
what it linked; the forests are joined into components.

Defined results: a null or empty text has no words and fingerprint zero, which links like any other. Null ids take part
and never name a component unless it has no other id. Repeated rows give repeated result rows. Texts of any length are read whole; bits set in
just half the shingles are zero. An empty table gives
an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantlake.llm.common import LOWER, UPPER, batches_of_bytes, store
from merchantlake.llm.components import components
from merchantlake.llm.xxh64 import remixed, xxh64_slices

BITS = 64
SHINGLE = 3
BUDGET = 3
PREFIX = 16
# A leaf holds about a 64th of the fingerprints, within these bounds, so that small and large tables are copied to about as
# many node pairs; the number of leaves is bounded, and with it that of their pairs.
LEAVES, LEAST_LEAF, LARGEST_LEAF, MAX_LEAVES = 64, 256, 1 << 20, 2048
# Two ranges with no more pairs than this are compared pair by pair instead of being split further.
SMALL_AREA = 48
PAIRS_AT_ONCE = 1 << 20
TEXT_AT_ONCE = 1 << 20
SEED = 42
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
# For each byte, its eight bits as eight byte-wide counters of one number.
COUNTERS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def _shingle_hashes(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of some texts, and how many each text has."""
    split = [(t or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() for t in texts]
    counts = np.array([len(w) for w in split], dtype=np.int64)
    data = b" ".join(b" ".join(w) for w in split if w)
    if not data:
        return np.empty(0, dtype=np.uint64), counts * 0
    ends = np.append(np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32), len(data))
    begins = np.append(0, ends[:-1] + 1)
    # Shingle i runs from word i to word i + size - 1, or to the text's last word when it has fewer words than that.
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first_word = np.cumsum(counts) - counts
    within = np.arange(shingles.sum()) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    first = np.repeat(first_word, shingles) + within
    last = first + np.repeat(np.minimum(counts, size), shingles) - 1
    return xxh64_slices(data, begins[first], ends[last] - begins[first], SEED), shingles


def _majorities(hashes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """For every text, the bits set in over half of its hashes; zero without hashes.

    Eight counters of a byte each travel in one number, so sums are taken over at most 255 hashes first.
    """
    out = np.zeros(len(shingles), dtype=np.int64)
    some = np.flatnonzero(shingles)
    if not len(some):
        return out
    n = shingles[some]
    pieces = -(-n // 255)
    piece_starts = np.repeat(np.cumsum(n) - n, pieces) + 255 * (
        np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    )
    counters = COUNTERS[hashes.astype(">u8").view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(counters, piece_starts, axis=0).view(np.uint8).reshape(-1, BITS)
    totals = np.add.reduceat(sums, np.cumsum(pieces) - pieces, axis=0, dtype=np.int64)
    out[some] = np.packbits(totals * 2 > n[:, None], axis=1).view(">i8").ravel()
    return out


def _fingerprints(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            parts = [
                _majorities(*_shingle_hashes(texts[b:e], shingle)) for b, e in batches_of_bytes(texts, TEXT_AT_ONCE)
            ]
            values = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "th": batch["th"], "fp": values})

    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp), one row per document: the text's hash, and its fingerprint as a signed 64-bit number."""
    given = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    hashed = given.withColumn("th", F.xxhash64("text"))
    found = hashed.mapInPandas(_fingerprints(shingle), "doc_id string, th bigint, fp bigint")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def _cut(counts: dict[int, int], limit: int, bits: int = PREFIX) -> dict[tuple[int, int], bool]:
    """Nodes (depth, prefix) of the upper trie; True marks a leaf: small enough, or as deep as the counts go."""
    totals: dict[tuple[int, int], int] = {}
    for prefix, n in counts.items():
        for depth in range(bits + 1):
            node = (depth, prefix >> (bits - depth))
            totals[node] = totals.get(node, 0) + n
    nodes: dict[tuple[int, int], bool] = {}
    todo = [(0, 0)] if totals else []
    while todo:
        node = todo.pop()
        nodes[node] = totals[node] <= limit or node[0] == bits
        if not nodes[node]:
            todo += [c for c in _children(node) if c in totals]
    return nodes


def _children(node: tuple[int, int]) -> list[tuple[int, int]]:
    depth, prefix = node
    return [(depth + 1, prefix * 2), (depth + 1, prefix * 2 + 1)]


def _differing(a: tuple[int, int], b: tuple[int, int]) -> int:
    depth = min(a[0], b[0])
    return ((a[1] >> (a[0] - depth)) ^ (b[1] >> (b[0] - depth))).bit_count()


def _leaf_pairs(nodes: dict[tuple[int, int], bool], budget: int) -> list[tuple]:
    """Pairs of leaves within the budget, found by walking node pairs from the root."""
    found, todo = [], [((0, 0), (0, 0))] if nodes else []
    while todo:
        a, b = todo.pop()
        if _differing(a, b) > budget:
            continue
        if nodes[a] and nodes[b]:
            found.append((a, b))
            continue
        left = [a] if nodes[a] else [c for c in _children(a) if c in nodes]
        right = [b] if nodes[b] else [c for c in _children(b) if c in nodes]
        todo += [(x, y) for x in left for y in right if a != b or x <= y]
    return found


def trie_matches(a: np.ndarray, b: np.ndarray, budget: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two sorted arrays whose values differ in at most ``budget`` bits; each pair once if ``same``.

    Ranges of both arrays that share a prefix are nodes. A pair of nodes is dropped when its prefixes differ in too many
    bits, compared when it is small, and otherwise split at the next bit. Work is taken in bounded portions.
    """
    whole = np.array([[0, len(a), 0, len(b)]], dtype=np.int64)
    stack = [(0, whole)] if len(a) and len(b) else []
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > PAIRS_AT_ONCE // 8:
            half = len(nodes) // 2
            stack += [(depth, nodes[half:]), (depth, nodes[:half])]
            continue
        area = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
        small = (area <= SMALL_AREA) | (depth == BITS)
        if small.any():
            yield from _compare(a, b, nodes[small], area[small], budget, same)
        nodes = nodes[~small]
        if not len(nodes):
            continue
        al, ah, bl, bh = nodes.T
        am, bm = _middle(a, al, depth), _middle(b, bl, depth)
        children = [(al, am, bl, bm), (am, ah, bm, bh), (al, am, bm, bh), (am, ah, bl, bm)]
        if same:
            once = al != bl  # below a node paired with itself, (one, zero) mirrors (zero, one)
            children[3] = tuple(x[once] for x in children[3])
        grown = np.concatenate([np.stack(c, axis=1) for c in children])
        grown = grown[(grown[:, 0] < grown[:, 1]) & (grown[:, 2] < grown[:, 3])]
        prefixes = (a[grown[:, 0]] ^ b[grown[:, 2]]) >> np.uint64(BITS - depth - 1)
        grown = grown[np.bitwise_count(prefixes) <= budget]
        if len(grown):
            stack.append((depth + 1, grown))


def _middle(values: np.ndarray, low: np.ndarray, depth: int) -> np.ndarray:
    """Where, in the range that begins at ``low``, the bit at ``depth`` turns to one."""
    bit = np.uint64(1 << (BITS - depth - 1))
    below = np.uint64((1 << (BITS - depth)) - 1)
    return np.searchsorted(values, (values[low] & ~below) | bit)


def _compare(a, b, nodes, area, budget, same):
    ends = np.cumsum(area)
    begin = 0
    while begin < len(nodes):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")))
        part, n = nodes[begin:end], area[begin:end]
        which = np.repeat(np.arange(len(part)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = (part[:, 3] - part[:, 2])[which]
        i, j = part[which, 0] + offset // width, part[which, 2] + offset % width
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            near &= i < j
        if near.any():
            yield i[near], j[near]
        begin = end


def _unite(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after linking i with j; a label is the smallest index of its set."""
    while True:
        x, y = labels[i], labels[j]
        apart = x != y
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            shorter = labels[labels]
            if (shorter == labels).all():
                break
            labels = shorter


def _link_leaves(budget: int):
    def link(group: pd.DataFrame) -> pd.DataFrame:
        values = group["fp"].to_numpy().view(np.uint64)
        right = group["right"].to_numpy()
        a, b = np.sort(values[~right]), np.sort(values[right])
        same = not len(b)
        matches = trie_matches(a, a if same else b, budget, same)
        nodes, shift = (a, 0) if same else (np.concatenate([a, b]), len(a))
        labels = np.arange(len(nodes))
        for i, j in matches:
            labels = _unite(labels, i, j + shift)
        moved = np.flatnonzero(labels != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[moved].view(np.int64), "b": nodes[labels[moved]].view(np.int64)})

    return link


def _plan(counts: dict[int, int], leaves: int, bits: int, budget: int):
    """(prefix, leaf) of every prefix, and (leaf, pair, right) of every leaf that takes part in a pair."""
    total = sum(counts.values())
    limit = max(min(max(total // leaves, LEAST_LEAF), LARGEST_LEAF), -(-total // MAX_LEAVES))
    nodes = _cut(counts, limit, bits)
    number = {node: k for k, node in enumerate(sorted(n for n, is_leaf in nodes.items() if is_leaf))}
    of_prefix = [
        (p, next(number[d, p >> (bits - d)] for d in range(bits + 1) if (d, p >> (bits - d)) in number)) for p in counts
    ]
    pairs = [(number[a], number[b]) for a, b in _leaf_pairs(nodes, budget)]
    sides = [(x, k, False) for k, (x, _) in enumerate(pairs)] + [(y, k, True) for k, (x, y) in enumerate(pairs) if x != y]
    return of_prefix, sides


def trie_links(values: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (a, b) that connect what differs in at most ``budget`` bits, from distinct ``fp``; values are stored."""
    spark = values.sparkSession
    prefix = F.shiftrightunsigned("fp", BITS - PREFIX)
    # At most 2**16 counts, whatever the size of the table.
    counts = {r[0]: r[1] for r in values.groupBy(prefix.alias("prefix")).count().collect()}
    of_prefix, sides = _plan(counts, LEAVES, PREFIX, budget)
    by_prefix = spark.createDataFrame(of_prefix, "prefix bigint, leaf int")
    by_leaf = spark.createDataFrame(sides, "leaf int, pair int, right boolean")
    dealt = (
        values.withColumn("prefix", prefix)
        .join(F.broadcast(by_prefix), "prefix")
        .join(F.broadcast(by_leaf), "leaf")
        .select("pair", "right", "fp")
    )
    return dealt.groupBy("pair").applyInPandas(_link_leaves(budget), "a bigint, b bigint")


def _component_names(folded: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component_id) from (node, least) and links between nodes."""
    roots = store(components(links), "roots")
    linked = roots.join(folded, "node")
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    named = linked.join(smallest, "root").select("node", "smallest")
    return store(folded.join(named, "node", "left").select("node", F.coalesce("smallest", "least").alias("component_id")), "named")


def _by_fingerprint(docs: DataFrame, doc_id: str, text: str, shingle: int, budget: int) -> DataFrame:
    """doc_id, th, fp and component_id of every row."""
    rows = store(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    folded = store(rows.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("least")), "folded")
    named = _component_names(folded, trie_links(folded.select(F.col("node").alias("fp")), budget))
    return rows.join(named.withColumnRenamed("node", "fp"), "fp", "left")


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = BUDGET
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links."""
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return _by_fingerprint(docs, doc_id, text, shingle, budget).select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def simhash_duplicates_removed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = BUDGET
) -> DataFrame:
    """The rows of ``docs`` whose id names the component of their fingerprint; of rows equal in id and text one stays.

    A component without any id keeps one of its rows for each text.
    """
    return _namesakes(docs, _by_fingerprint(docs, doc_id, text, shingle, budget), doc_id, text)


# Similar texts. Two texts that share 0.8 of their shingles differ in about 15% of the bits of a fingerprint, far more than
# a trie can search. Candidates come from bands of minima instead: two texts agree in a minimum with a chance equal to their
# similarity, whatever their length, and in no band at 0.8 with a chance of (1 - 0.8 ** 4) ** 24, three in a million.
# Every candidate is then held against the shingles themselves.

SIMILAR_SHINGLE = 5
SIMILARITY = 0.8
BANDS, MINIMA = 24, 4
MIXERS = np.random.default_rng(SEED).integers(0, 1 << 64, (BANDS * MINIMA, 2), dtype=np.uint64) | np.array([0, 1], dtype=np.uint64)


def allowed_bits(similarity: float, bits: int = 5 * BITS) -> int:
    """Bits that may differ at a Jaccard similarity: the expected number by the angle, and one standard deviation.

    An estimate only; similar texts are told by their shingles.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * share + math.sqrt(bits * share * (1 - share)))


def _shingle_sets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the shingles of some texts, and how many each text has."""
    hashes, shingles = _shingle_hashes(texts, size)
    owner = np.repeat(np.arange(len(shingles)), shingles)
    order = np.lexsort((hashes, owner))
    hashes = hashes[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[first], np.bincount(owner[first], minlength=len(shingles))


def _digests(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number for each set, zero for an empty one."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        n = sizes[some]
        out[some] = remixed(np.add.reduceat(remixed(hashes, 1), np.cumsum(n) - n) ^ n.astype(np.uint64), 2)
    return out.view(np.int64)


def _bands(hashes: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The keys of each set's bands; an empty set has none."""
    some = np.flatnonzero(sizes)
    out = [np.empty(0, dtype=np.int64)] * len(sizes)
    if not len(some):
        return out
    starts = np.cumsum(sizes[some]) - sizes[some]
    keys = np.zeros((len(some), BANDS), dtype=np.uint64)
    for k, (flip, factor) in enumerate(MIXERS):
        least = np.minimum.reduceat((hashes ^ flip) * factor, starts)
        keys[:, k // MINIMA] = remixed(keys[:, k // MINIMA] ^ least, k + 1)
    for i, row in zip(some, keys.view(np.int64)):
        out[i] = row
    return out


def _sketches(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            nodes, sizes, keys = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], []
            for b, e in batches_of_bytes(texts, TEXT_AT_ONCE):
                sets = _shingle_sets(texts[b:e], shingle)
                nodes.append(_digests(*sets))
                sizes.append(sets[1])
                keys += _bands(*sets)
            ids = batch[["doc_id", "th"]].reset_index(drop=True)
            yield ids.assign(node=np.concatenate(nodes), n=np.concatenate(sizes), keys=keys)

    return run


def _noded(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            parts = [_digests(*_shingle_sets(texts[b:e], shingle)) for b, e in batches_of_bytes(texts, TEXT_AT_ONCE)]
            yield pd.DataFrame({"node": np.concatenate([np.empty(0, dtype=np.int64), *parts]), "text": batch["text"]})

    return run


def jaccard(left: list[str | None], right: list[str | None], shingle: int) -> np.ndarray:
    """The similarity of each pair of texts by their sets of shingles; two empty sets are equal."""
    out = np.ones(len(left))
    both = [(x or "") + " " + (y or "") for x, y in zip(left, right)]
    for b, e in batches_of_bytes(both, TEXT_AT_ONCE):
        hashes, sizes = _shingle_sets(left[b:e] + right[b:e], shingle)
        sets = np.split(hashes, np.cumsum(sizes)[:-1])
        for k in range(e - b):
            x, y = sets[k], sets[k + e - b]
            shared = len(np.intersect1d(x, y, assume_unique=True))
            if len(x) + len(y):
                out[b + k] = shared / (len(x) + len(y) - shared)
    return out


def _verified(shingle: int, similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = jaccard(batch["x"].tolist(), batch["y"].tolist(), shingle) >= similarity
            yield batch.loc[near, ["a", "b"]]

    return run


def _similar_pairs(pairs: DataFrame, given: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Those of the candidates (a, b) whose texts are similar. The texts of a node differ at most outside its shingles."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = given.select("text").mapInPandas(_noded(shingle), "node bigint, text string").dropDuplicates(["node"])
    texts = store(texts.join(wanted, "node", "left_semi"), "candidate-texts")
    one, other = (texts.select(F.col("node").alias(n), F.col("text").alias(t)) for n, t in (("a", "x"), ("b", "y")))
    met = pairs.join(one, "a").join(other, "b").select("a", "b", "x", "y")
    return store(met.mapInPandas(_verified(shingle, similarity), "a bigint, b bigint"), "similar")


def _may_share(n: Column, m: Column, similarity: float) -> Column:
    """Sets of these sizes can be so similar: the smaller one has that share of the larger at least."""
    return F.least(n, m) >= F.greatest(n, m) * similarity


def similar_links(folded: DataFrame, given: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links (a, b) that connect all candidates that are similar, from distinct (node, n, keys); both inputs are read again.

    In every band's group each node is held against the smallest first. Only groups that this leaves in several components
    have more candidates: the nodes apart from the smallest node's component, with those of other components. Sets whose
    sizes are too different cannot be similar and are no candidates.
    """
    keyed = folded.select("node", "n", F.explode("keys").alias("key"))
    head = F.min(F.struct("node", "n")).alias("head")
    shared = keyed.groupBy("key").agg(head, F.max("node").alias("last")).where("head.node != last")
    shared = shared.select("key", F.col("head.node").alias("head"), F.col("head.n").alias("head_n"))
    members = store(keyed.join(shared, "key"), "members")
    near = members.where((F.col("node") != F.col("head")) & _may_share(F.col("n"), F.col("head_n"), similarity))
    first = store(near.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "candidates")
    links = _similar_pairs(first, given, shingle, similarity)
    roots = store(components(links), "first-roots")
    named = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_heads = roots.select(F.col("node").alias("head"), F.col("root").alias("head_root"))
    named = named.join(of_heads, "head", "left").withColumn("head_root", F.coalesce("head_root", "head"))
    named = store(named.select("key", "node", "n", "head", "root", "head_root"), "named-members")
    apart = named.where("root != head_root").select("key", F.col("node").alias("x"), F.col("n").alias("x_n"), F.col("root").alias("x_root"))
    others = named.where("node != head").select("key", "node", "n", "root")
    met = apart.join(others, "key").where((F.col("x_root") != F.col("root")) & _may_share(F.col("n"), F.col("x_n"), similarity))
    more = met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
    second = store(more.join(first, ["a", "b"], "left_anti"), "more-candidates")
    return links.unionByName(_similar_pairs(second, given, shingle, similarity))


def similar_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SIMILAR_SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """doc_id, th (the text's hash), component_id over links between texts that share at least ``similarity`` of their shingles."""
    given = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    hashed = given.withColumn("th", F.xxhash64("text"))
    found = hashed.mapInPandas(_sketches(shingle), "doc_id string, th bigint, node bigint, n bigint, keys array<bigint>")
    rows = store(found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType)), "sketches")
    folded = store(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("keys").alias("keys")), "folded")
    named = _component_names(folded.select("node", "least"), similar_links(folded, given, shingle, similarity))
    return rows.join(named, "node", "left").select("doc_id", "th", "component_id")


def _namesakes(docs: DataFrame, named: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of ``docs`` whose id names their component, from doc_id, th and component_id of all; equal ones once."""
    names = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = store(named.where(names).select("doc_id", "th").distinct(), "kept")
    # An id can also be that of a text in another component: a row stays for its text.
    rows, ids = docs.alias("d"), kept.alias("k")
    same = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("k.doc_id")) & (F.xxhash64(F.col(f"d.`{text}`").cast("string")) == F.col("k.th"))
    return rows.join(ids, same, "left_semi").dropDuplicates([doc_id, text])


def near_duplicates_removed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SIMILAR_SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """The rows of ``docs`` whose id names the component of their text; of rows equal in id and text one stays.

    A component without any id keeps one of its rows for each text.
    """
    return _namesakes(docs, similar_components(docs, doc_id, text, shingle, similarity), doc_id, text)
