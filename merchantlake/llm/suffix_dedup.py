"""Suffix-array dedup: remove every byte covered by a string of 100 bytes that also starts earlier in the corpus.

Which suffixes can repeat is found first, exactly: the smallest hashed 20-gram of a 100-byte string, its anchor, depends on
nothing but these bytes, so equal strings have equal anchors. Neighbouring strings share anchors; the text around an
anchor that holds all of its strings is a context. Equal contexts are folded, first within a task, then by anchor: the
later ones are repeats as a whole. Where an anchor is left with different contexts, these are cut out of their texts
and dealt out by anchor; shards of them get a Burrows-Wheeler transform each, the transforms are merged by
interleave refinement, and the repeated intervals of at least 100 bytes say which strings started earlier.

An anchor with very many different contexts is not gathered: its strings are folded by digest, in tasks and then by key.

Defined results: a null text is empty. Ids are integers; a null id comes after all others. Rows equal in id and text are
one document, and each of them gets its result; different texts under one id are different documents, ordered by a hash
of the text. Matches never cross documents. An empty table gives an empty result. Digests have 64 bits beside the 64 of
their anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchantlake.llm.common import batches_of_bytes, partitions, store, text_of
from merchantlake.llm.interleave import later_windows

LENGTH = 100
GRAM = 20
#: Bytes handled at once; their positions fit the low bits of an anchor's sort key.
BLOCK = 1 << 18
POSITION_BITS = 22
LAST_ID = (1 << 63) - 1
#: Contexts of one anchor that are merged in one task, and bytes merged at once.
MAX_CONTEXTS = 2000
MERGE_BYTES = 1 << 16
#: Text whose contexts are folded at once.
FOLD_TEXT = 1 << 22
SHARD_STRINGS = 64
MIX = np.uint64(0x9E3779B97F4A7C15)
# Two independent polynomial hashes: odd bases and random byte values.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
VALUES = np.random.Generator(np.random.PCG64(20240101)).integers(1, 1 << 63, (2, 256), dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=2)
def _powers(kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = 2 * BLOCK + LENGTH
    out = []
    for base in (BASES[kind], pow(BASES[kind], -1, 1 << 64)):
        powers = np.full(size, base, dtype=np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


class _Hashed:
    """Hashes of any slice of a piece of text."""

    def __init__(self, data: np.ndarray, kind: int):
        self.up, self.down = _powers(kind)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(VALUES[kind][data] * self.up[: len(data)], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.down[begin]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima within rows."""
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def _contexts(data: np.ndarray, valid: np.ndarray):
    """Anchor hash, context digest, first and last string, and anchor, of each context; ``valid`` marks string starts."""
    first, second = _Hashed(data, 0), _Hashed(data, 1)
    begins = np.arange(len(data) - GRAM + 1)
    grams = _mix(first(begins, begins + GRAM))
    low = np.uint64((1 << POSITION_BITS) - 1)
    anchor = (_sliding_least((grams & ~low) | begins.astype(np.uint64), LENGTH - GRAM + 1) & low).astype(np.int64)
    starts = np.flatnonzero(valid)
    own = anchor[starts]
    cut = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
    lo, hi, at = starts[cut], starts[np.append(cut[1:], len(starts)) - 1], own[cut]
    shape = ((at - lo) * 256 + (hi - lo)).astype(np.uint64)
    digest = _mix(first(lo, hi + LENGTH) * MIX + second(lo, hi + LENGTH) + _mix(shape + MIX))
    return grams[at].view(np.int64), digest.view(np.int64), lo, hi, at


def _pieces(texts: list[str | None]):
    """Portions of text: bytes, the row of each document in it, where it begins there, and its offset in the row's text.

    A long text is cut into overlapping pieces, so that each of its strings lies in just one.
    """
    portion, size = [], 0
    for row, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if len(raw) < LENGTH:
            continue
        for offset in range(0, len(raw) - LENGTH + 1, BLOCK):
            piece = raw[offset : offset + BLOCK + LENGTH - 1]
            portion.append((row, offset, piece))
            size += len(piece)
            if size >= BLOCK:
                yield portion
                portion, size = [], 0
    if portion:
        yield portion


def _anchors_of(texts: list[str | None]) -> pd.DataFrame:
    found = []
    for portion in _pieces(texts):
        lengths = np.array([len(p) for _, _, p in portion])
        data = np.frombuffer(b"".join(p for _, _, p in portion), dtype=np.uint8)
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(portion)), lengths)
        place = np.arange(len(data) - LENGTH + 1)
        h, c, lo, hi, at = _contexts(data, place + LENGTH <= ends[owner[: len(place)]])
        piece = owner[lo]
        shift = np.array([o for _, o, _ in portion]) - (ends - lengths)
        found.append(pd.DataFrame({
            "row": np.array([r for r, _, _ in portion])[piece], "h": h, "c": c,
            "place": ((lo + shift[piece]) << 16) | ((at - lo) << 8) | (hi - lo),
        }))
    return pd.concat(found) if found else pd.DataFrame({"row": [], "h": [], "c": [], "place": []}, dtype=np.int64)


def _fold(rows: pd.DataFrame) -> pd.DataFrame:
    """Mark rows whose (h, c) came before; rows come in corpus order, and the earliest of each stays under its key."""
    h, c = rows["h"].to_numpy(), rows["c"].to_numpy()
    order = np.argsort(_mix(h.view(np.uint64) ^ _mix(c.view(np.uint64))), kind="stable")
    h, c = h[order], c[order]
    rows = rows.iloc[order]
    again = np.zeros(len(rows), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
    # A repeat needs its key no more: spread over the partitions, it cannot make a common key heavy.
    spread = _mix((rows["id"].to_numpy() ^ (rows["place"].to_numpy() << 7)).view(np.uint64)).view(np.int64)
    return rows.assign(again=again, h=np.where(again, spread, h))[["again", "h", "c", "id", "th", "place"]]


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch = batch.drop_duplicates(["id", "th"]).sort_values(["id", "th"])
        ids, ths, texts = batch["id"].to_numpy(), batch["th"].to_numpy(), batch["text"].tolist()
        for begin, end in batches_of_bytes(texts, FOLD_TEXT):
            found = _anchors_of(texts[begin:end])
            row = found["row"].to_numpy() + begin
            yield _fold(found.assign(id=ids[row], th=ths[row]))


def _bounds(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last string of a context."""
    lo = place >> 16
    return lo, lo + (place & 0xFF)


def _cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of each open context of some documents."""
    for batch in batches:
        texts = batch["text"].tolist()
        for begin, end in batches_of_bytes(texts, FOLD_TEXT):
            rows = batch.iloc[begin:end]
            places = rows["place"].tolist()
            context = []
            for text, place in zip(texts[begin:end], places):
                raw = text.encode("utf-8", "surrogatepass")
                lo, hi = _bounds(place)
                context += [raw[a:b] for a, b in zip(lo.tolist(), (hi + LENGTH).tolist())]
            times = [len(p) for p in places]
            yield pd.DataFrame({
                "h": np.concatenate(rows["h"].tolist()), "n": np.concatenate(rows["n"].tolist()), "id": np.repeat(rows["id"].to_numpy(), times),
                "th": np.repeat(rows["th"].to_numpy(), times), "place": np.concatenate(places), "context": context,
            })


def _runs(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
    """Removed ranges from single strings: (row of ``rows``, offset), in order."""
    row, at = starts[:, 0], starts[:, 1]
    new = (np.diff(row, prepend=-1) != 0) | (np.diff(at, prepend=-2) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    of = rows.iloc[row[first]]
    base = of["place"].to_numpy() >> 16
    return pd.DataFrame({"id": of["id"].array, "th": of["th"].array, "begin": base + at[first], "end": base + at[last] + LENGTH})


NOTHING = {c: np.empty(0, dtype=np.int64) for c in ("id", "th", "begin", "end")}


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """Strings of some anchors' contexts that occur in an earlier context."""
    strings = group["context"].tolist()
    # Anchors could share a context only if hashes collide; equal strings may not reach the merge.
    windows = (group["place"].to_numpy() & 0xFF) + 1
    different = ~group["context"].duplicated().to_numpy()
    kept = np.flatnonzero(different)
    if len(kept) < 2:
        return pd.DataFrame(NOTHING)
    later = later_windows([strings[k] for k in kept], windows[kept], np.arange(len(kept)) // SHARD_STRINGS, LENGTH)
    if not len(later):
        return pd.DataFrame(NOTHING)
    later = later[np.lexsort((later[:, 1], later[:, 0]))]
    return _runs(group.iloc[kept], later)


def _merge_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by anchor. Whole anchors are gathered up to a size, then merged."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(len(b) for b in held) * 2 * LENGTH < MERGE_BYTES:
            continue
        rows = pd.concat(held, ignore_index=True)
        borders = np.flatnonzero(np.diff(rows["h"].to_numpy()) != 0) + 1
        size = np.cumsum(rows["context"].map(len).to_numpy() + 1)
        begin = 0
        for i, border in enumerate(borders):
            full = size[border - 1] - (size[begin - 1] if begin else 0) >= MERGE_BYTES
            if full or i == len(borders) - 1:
                yield _merged(rows.iloc[begin:border])
                begin = border
        held = [rows.iloc[begin:]]
    if held:
        yield _merged(pd.concat(held, ignore_index=True))


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of every string of a context, folded within the batch."""
    at_once = BLOCK // LENGTH  # a context has fewer than 2 * LENGTH bytes: what is hashed at once is no longer than the powers
    for batch in batches:
        parts = []
        for begin in range(0, len(batch), at_once):
            rows = batch.iloc[begin : begin + at_once]
            sizes = rows["context"].map(len).to_numpy()
            data = np.frombuffer(b"".join(rows["context"]), dtype=np.uint8)
            lo, hi = _bounds(rows["place"].to_numpy())
            n = hi - lo + 1
            which = np.repeat(np.arange(len(rows)), n)
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = (np.cumsum(sizes) - sizes)[which] + offset
            parts.append(pd.DataFrame({
                "h": _mix(_Hashed(data, 0)(at, at + LENGTH)).view(np.int64), "c": _mix(_Hashed(data, 1)(at, at + LENGTH)).view(np.int64),
                "id": rows["id"].to_numpy()[which], "th": rows["th"].to_numpy()[which], "place": lo[which] + offset,
            }))
        if parts:
            yield _fold(pd.concat(parts).sort_values(["id", "th", "place"]))


FOLDED = "again boolean, h bigint, c bigint, id bigint, th bigint, place bigint"
RESULTS = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string", "kept_text": "string"}
RANGES = "id bigint, th bigint, begin bigint, end bigint"


def _with_neighbour(folded: DataFrame) -> DataFrame:
    """Rows once each, with the digest before them in their anchor's order."""
    order = Window.partitionBy("again", "h").orderBy("c", "id", "th", "place")
    rows = folded.withColumn("before", F.lag(F.struct("c", "id", "th", "place")).over(order))
    same = (F.col("before.c") == F.col("c")) & (F.col("before.id") == F.col("id")) & (F.col("before.th") == F.col("th"))
    return rows.where(~F.coalesce(same & (F.col("before.place") == F.col("place")), F.lit(False)))


def removed_ranges(keyed: DataFrame) -> DataFrame:
    """(id, th, begin, end) of byte ranges to remove, from (id, th, text). Ranges of a document may overlap."""
    spark = keyed.sparkSession
    folded = keyed.where(F.octet_length("text") >= LENGTH).mapInPandas(_anchors, FOLDED)
    of_anchor = Window.partitionBy("again", "h").orderBy("c", "id", "th", "place").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    compared = _with_neighbour(folded).withColumns(
        {"n": F.count(F.lit(1)).over(of_anchor), "least": F.first("c").over(of_anchor), "most": F.last("c").over(of_anchor)}
    )
    repeat = F.col("again") | F.coalesce(F.col("before.c") == F.col("c"), F.lit(False))
    kinds = compared.select("h", "n", "id", "th", "place", repeat.alias("repeat"), (F.col("least") != F.col("most")).alias("mixed"))
    found = store(kinds.where("repeat or mixed"), "anchors")
    lo, span = F.shiftright("place", 16), F.col("place").bitwiseAND(F.lit(0xFF))
    whole = found.where("repeat").select("id", "th", lo.alias("begin"), (lo + span + LENGTH).alias("end"))

    def cut_out(anchors: DataFrame) -> DataFrame:
        """Contexts as bytes. A document has no more of them than anchors."""
        by_document = anchors.groupBy("id", "th").agg(F.collect_list(F.struct("h", "n", "place")).alias("a"))
        by_document = by_document.select("id", "th", "a.h", "a.n", "a.place")
        return keyed.join(by_document, ["id", "th"]).mapInPandas(
            _cut_out, "h bigint, n bigint, id bigint, th bigint, place bigint, context binary"
        )

    few, many = (found.where(F.expr(f"not repeat and n {sign} {MAX_CONTEXTS}")) for sign in ("<=", ">"))
    gathered = cut_out(few).repartition(partitions(spark), "h").sortWithinPartitions("h", "id", "th", "place")
    ranges = whole.unionByName(gathered.mapInPandas(_merge_contexts, RANGES))
    if not many.isEmpty():
        # Strings of anchors with more contexts than one task should hold meet by digest instead.
        strings = _with_neighbour(cut_out(many).mapInPandas(_strings, FOLDED))
        later = strings.where(F.col("again") | F.coalesce(F.col("before.c") == F.col("c"), F.lit(False)))
        ranges = ranges.unionByName(later.select("id", "th", F.col("place").alias("begin"), (F.col("place") + LENGTH).alias("end")))
    return ranges


def _unite(begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Ranges that do not touch, from ranges in any order."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.append(True, begins[1:] > reach[:-1]))
    return list(zip(begins[new].tolist(), reach[np.append(new[1:], len(begins)) - 1].tolist()))


def _keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, begins, ends in zip(batch["text"], batch["begins"], batch["ends"]):
            raw = text.encode("utf-8", "surrogatepass")
            spans = [] if begins is None else _unite(begins, ends)
            edges = [0, *[x for span in spans for x in span], len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])) if spans else raw
            whole = kept.decode("utf-8", "ignore") if spans else text
            rows.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), whole))
        out = batch.drop(columns=["id", "th", "text", "begins", "ends"]).reset_index(drop=True)
        yield pd.concat([out, pd.DataFrame(rows, columns=list(RESULTS))], axis=1)


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", others: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text, and ``others``: columns of the input to carry along.

    ``kept_text`` leaves out what a cut through a character leaves of it; the digest is of the kept bytes as they are.
    """
    id_ = F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(LAST_ID))
    body = text_of(F.col(f"`{text}`"))
    keyed = docs.select(id_.alias("id"), F.xxhash64(body).alias("th"), body.alias("text"))
    rows = docs.select(
        id_.alias("id"), F.xxhash64(body).alias("th"), body.alias("text"), F.col(f"`{doc_id}`").cast("string").alias("doc_id"),
        *[F.col(f"`{c}`").alias(f"other_{k}") for k, c in enumerate(others)],
    )
    ranges = removed_ranges(keyed).groupBy("id", "th").agg(F.collect_list(F.struct("begin", "end")).alias("r"))
    ranges = ranges.select("id", "th", F.col("r.begin").alias("begins"), F.col("r.end").alias("ends"))
    carried = [f for f in rows.schema.fields if f.name == "doc_id" or f.name.startswith("other_")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in carried)
    kept = rows.join(ranges, ["id", "th"], "left").mapInPandas(
        _keep, f"{schema}, {', '.join(f'{c} {kind}' for c, kind in RESULTS.items())}"
    )
    kept = kept.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
    return kept.withColumnsRenamed({f"other_{k}": c for k, c in enumerate(others)})
