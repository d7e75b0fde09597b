"""Substring dedup: remove every word of a window of 13 words that also starts in an earlier document, by FM-indexes.

Equal windows have equal anchors: of a window's 4-word grams, the one with the least hash, which depends on nothing but
these words. Neighbouring windows share anchors; the words of all windows of one anchor in a row are a context. First come
the anchors that more than one document has. Their contexts are dealt out by anchor, the same ones folded to the first of
them; the contexts of a share of anchors are a shard. A shard gets a compressed FM-index (``fm_index``), and every
context is searched backward in it: its matching statistics, against contexts of earlier documents alone, say which windows
occurred before. Copies of a context follow the first of them: whole, if in a later document.

An anchor with very many different contexts is no single task's work: its windows are folded one by one instead, which leaves
none to search for, as different windows have no 13 words in common.

Defined results: a null text has no words. Ids are integers; null ids come after all others. Documents under one id are equally
early, so none takes words from another. Rows equal in id and text get the same result each. Windows never cross documents.
A text of any length is handled in pieces. An empty table gives an empty result. Words are compared by 64-bit hashes, anchors
and contexts by 128 bits together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantlake.llm.common import partitions, store, text_of
from merchantlake.llm.fm_index import FMIndex

WINDOW = 13
GRAM = 4
WHITE = re.compile(rb"[\x20\x09-\x0D]")
LAST_ID = (1 << 63) - 1
#: Bytes of text whose contexts are found together, and words that one FM-index holds.
PIECE = 1 << 21
SHARD_WORDS = 1 << 18
#: Different contexts of an anchor up to which one task searches them.
MAX_CONTEXTS = 1 << 14
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD6E8FEB86659FD93
FACTORS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, dtype=np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A text cut at white space into pieces of about PIECE bytes."""
    begin = 0
    while len(raw) - begin > PIECE:
        cut = WHITE.search(raw, begin + PIECE)
        if cut is None:
            break
        yield raw[begin : cut.start()]
        begin = cut.start()
    yield raw[begin:]


def _word_hashes(raw: bytes) -> list[np.ndarray]:
    found = []
    for piece in _pieces(raw):
        words = np.empty(len(split := piece.split()), dtype=object)
        words[:] = split
        if len(words):
            found.append(pd.util.hash_array(words, categorize=False))
    return found


def _portions(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Portions of words: their hashes, the number of the text each is of, and its place in the text.

    The last words of a portion that ends within a text begin the next one, so that each window lies in just one.
    """
    most = PIECE // 4
    parts: list[tuple[int, int, np.ndarray]] = []
    size = 0
    for k, raw in enumerate(texts):
        place = 0
        for hashes in _word_hashes(raw):
            parts.append((k, place, hashes))
            place += len(hashes)
            size += len(hashes)
            if size >= most:
                yield _joined(parts)
                # Only the text at hand can go on.
                tail = np.concatenate([h for o, _, h in parts if o == k])[-(WINDOW - 1) :]
                parts, size = [(k, place - len(tail), tail)], len(tail)
    if size:
        yield _joined(parts)


def _joined(parts: list[tuple[int, int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(h) for _, _, h in parts]
    owner = np.repeat([k for k, _, _ in parts], sizes)
    place = np.concatenate([np.arange(b, b + n) for (_, b, _), n in zip(parts, sizes)])
    return np.concatenate([h for _, _, h in parts]), owner, place


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of every ``width`` neighbours, the first of equal ones."""
    best, at = values[: len(values) - width + 1].copy(), np.arange(len(values) - width + 1)
    for k in range(1, width):
        other = values[k : k + len(best)]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + k
    return at


def _contexts(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, digest, first and last window of each context."""
    n = len(words)
    if n < WINDOW:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    grams = np.zeros(n - GRAM + 1, dtype=np.uint64)
    for k, factor in enumerate(FACTORS):
        grams += words[k : k + len(grams)] * factor
    grams = _mix(grams)
    anchor = _least_of(grams, WINDOW - GRAM + 1)
    starts = np.flatnonzero(owner[: n - WINDOW + 1] == owner[WINDOW - 1 :])
    own = anchor[starts]
    cut = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
    lo, hi, at = starts[cut], starts[np.append(cut[1:], len(starts)) - 1], own[cut]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_mix(words + MIX) * _powers(BASE, n), out=sums[1:])
    digest = (sums[hi + WINDOW] - sums[lo]) * _powers(pow(BASE, -1, 1 << 64), n)[lo]
    return grams[at].view(np.int64), _mix(digest + (hi - lo).astype(np.uint64) * MIX).view(np.int64), lo, hi


def _found(batch: pa.RecordBatch) -> Iterator[pd.DataFrame]:
    """Contexts of the documents of a batch, a portion at a time: h, c, id, th, place."""
    ids, ths = batch.column("id").to_numpy(), batch.column("th").to_numpy()
    first = np.sort(np.unique(np.stack([ids, ths]), axis=1, return_index=True)[1])  # a repeated row counts once
    texts = batch.column("text")
    for words, owner, place in _portions([texts[k].as_py() for k in first.tolist()]):
        h, c, lo, hi = _contexts(words, owner)
        row = first[owner[lo]]
        yield pd.DataFrame({"h": h, "c": c, "id": ids[row], "th": ths[row], "place": (place[lo] << 8) | (hi - lo)})


def _sent(rows: pd.DataFrame) -> pa.RecordBatch:
    return pa.RecordBatch.from_pandas(rows, preserve_index=False)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each anchor with its first and last document."""
    for batch in batches:
        for rows in _found(batch):
            order = np.lexsort((rows["id"], rows["h"]))
            h, ids = rows["h"].to_numpy()[order], rows["id"].to_numpy()[order]
            begin = np.flatnonzero(np.diff(h, prepend=~h[:1]) != 0)
            if len(begin):
                yield _sent(pd.DataFrame({"h": h[begin], "first": ids[begin], "last": ids[np.append(begin[1:], len(h)) - 1]}))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts; those that an earlier document of the portion has are marked. These need their anchor no more: spread over
    the partitions, they cannot make a common one heavy.
    """
    for batch in batches:
        for rows in _found(batch):
            order = np.lexsort((rows["place"], rows["id"], rows["c"], rows["h"]))
            rows = rows.iloc[order]
            h, c, ids = rows["h"].to_numpy(), rows["c"].to_numpy(), rows["id"].to_numpy()
            begin = np.flatnonzero((np.diff(h, prepend=~h[:1]) != 0) | (np.diff(c, prepend=~c[:1]) != 0))
            again = ids > np.repeat(ids[begin], np.diff(np.append(begin, len(rows))))
            spread = _mix((ids ^ (rows["place"].to_numpy() << 7)).view(np.uint64)).view(np.int64)
            if len(rows):
                yield _sent(rows.assign(again=again, h=np.where(again, spread, h)))


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the contexts of some documents: whole, or a window at a time."""
    for batch in batches:
        columns = [batch.column(k) for k in ("id", "text", "h", "c", "place", "single")]
        for k in range(batch.num_rows):
            id_, raw, h, c, place, single = (x[k].as_py() for x in columns)
            words = np.concatenate(_word_hashes(raw))
            rows = []
            for anchor, digest, at, alone in zip(h, c, place, single):
                lo, windows = at >> 8, (at & 0xFF) + 1
                if not alone:
                    rows.append((anchor, digest, 0, id_, words[lo : lo + windows + WINDOW - 1].tobytes()))
                    continue
                rows += [(anchor, digest, w + 1, id_, words[lo + w : lo + w + WINDOW].tobytes()) for w in range(windows)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            names = ["h", "c", "window", "id", "words"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)


def _searched(rows: list[tuple]) -> pa.RecordBatch:
    """The windows of a shard's contexts that earlier documents have, as bits."""
    flat = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint64)
    ends = np.cumsum([len(r[3]) // 8 for r in rows])
    numbers = np.unique(flat, return_inverse=True)[1]
    owner = np.unique(np.array([r[2] for r in rows], dtype=np.int64), return_inverse=True)[1]
    statistics = FMIndex(numbers, ends, owner, WINDOW).matching_statistics(numbers, ends, owner)
    of = np.repeat(np.arange(len(rows)), np.diff(ends, prepend=0))
    place = np.arange(len(flat)) - np.append(0, ends[:-1])[of]
    whole = statistics >= WINDOW
    bits = np.zeros(len(rows), dtype=np.int64)
    np.bitwise_or.at(bits, of[whole], 1 << place[whole])
    hit = np.flatnonzero(bits)
    return pa.RecordBatch.from_arrays(
        [pa.array([rows[k][0] for k in hit], pa.int64()), pa.array([rows[k][1] for k in hit], pa.int64()), pa.array(bits[hit])], ["h", "c", "bits"]
    )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor. Whole anchors are gathered to shards."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("h", "c", "id", "words"))):
            if size >= SHARD_WORDS and held[-1][0] != row[0]:
                yield _searched(held)
                held, size = [], 0
            held.append(row)
            size += len(row[3]) // 8
    if held:
        yield _searched(held)


KEYS = "h bigint, c bigint, id bigint, th bigint, place bigint"
RESULTS = {"n_words": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept_text": pa.string()}
ALL_WINDOWS = -1


def removed_windows(docs: DataFrame) -> DataFrame:
    """(id, th, place, bits): windows of documents (id, th, text as bytes) that earlier documents have."""
    spark = docs.sparkSession
    long = docs.where(F.octet_length("text") >= 2 * WINDOW - 1)
    anchors = long.mapInArrow(_anchors, "h bigint, first bigint, last bigint")
    shared = anchors.groupBy("h").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first < last")
    shared = store(shared.select("h"), "shared-anchors")
    contexts = long.mapInArrow(_folded, f"{KEYS}, again boolean").join(shared.withColumn("known", F.lit(True)), "h", "left")
    contexts = store(contexts.where("again or known").drop("known"), "contexts")
    own = contexts.where("not again")
    firsts = own.groupBy("h", "c").agg(F.min(F.struct("id", "th", "place")).alias("first"))
    firsts = store(firsts.select("h", "c", "first.*"), "first-contexts")
    several = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sought = firsts.join(several, "h").select("id", "th", F.struct("h", "c", "place", (F.col("n") > MAX_CONTEXTS).alias("single")).alias("x"))
    by_document = sought.groupBy("id", "th").agg(F.collect_list("x").alias("x"))
    by_document = by_document.select("id", "th", *[F.col(f"x.{c}").alias(c) for c in ("h", "c", "place", "single")])
    cut = by_document.join(long.dropDuplicates(["id", "th"]), ["id", "th"])
    cut = store(cut.mapInArrow(_cut_out, "h bigint, c bigint, window int, id bigint, words binary"), "cut-out")
    in_shards = cut.where("window = 0").repartition(partitions(spark), "h").sortWithinPartitions("h")
    found = in_shards.select("h", "c", "id", "words").mapInArrow(_search, "h bigint, c bigint, bits bigint")
    single = cut.where("window > 0")
    earliest = single.groupBy("words").agg(F.min("id").alias("earliest"))
    later = single.join(earliest, "words").where("id > earliest")
    found = found.unionByName(later.groupBy("h", "c").agg(F.expr("bit_or(shiftleft(1L, window - 1))").alias("bits")))
    judged = firsts.select("h", "c", F.col("id").alias("first_id")).join(found, ["h", "c"], "left")
    copies = own.join(judged, ["h", "c"]).where("id > first_id or bits is not null")
    hits = copies.select("id", "th", "place", F.when(F.col("id") > F.col("first_id"), ALL_WINDOWS).otherwise(F.col("bits")).alias("bits"))
    return hits.unionByName(contexts.where("again").select("id", "th", "place", F.lit(ALL_WINDOWS).cast("bigint").alias("bits")))


def _covered(n: int, hits: list[dict]) -> np.ndarray:
    """Which of n words lie in a window that was found."""
    change = np.zeros(n + 1, dtype=np.int64)
    for hit in hits:
        lo, windows = hit["place"] >> 8, (hit["place"] & 0xFF) + 1
        if hit["bits"] == ALL_WINDOWS:
            change[lo] += 1
            change[lo + windows + WINDOW - 1] -= 1
            continue
        for k in range(windows):
            if hit["bits"] >> k & 1:
                change[lo + k] += 1
                change[lo + k + WINDOW] -= 1
    return np.cumsum(change[:n]) > 0


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        texts, hits = batch.column("text"), batch.column("hits")
        for k in range(batch.num_rows):
            words, found = texts[k].as_py().split(), hits[k].as_py()
            kept, spans = words, 0
            if found:
                gone = _covered(len(words), found)
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
            whole = b" ".join(kept)
            rows.append((len(words), len(words) - len(kept), spans, hashlib.sha256(whole).hexdigest(), whole.decode("utf-8", "replace")))
        if rows:
            results = [pa.array(x, t) for x, t in zip(zip(*rows), RESULTS.values())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *results], ["row", *RESULTS])


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``document``, the input row, with n_words, n_removed, n_spans (runs of removed words), kept_sha256 and kept_text."""
    id_ = F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(LAST_ID)).alias("id")
    body = text_of(F.col(f"`{text}`"))
    others = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns) if c != text]
    keyed = docs.select(id_, F.xxhash64(body).alias("th"), body.cast("binary").alias("text"), F.struct(*others, F.lit(0).alias("_")).alias("row"))
    hits = removed_windows(keyed.drop("row")).groupBy("id", "th").agg(F.collect_set(F.struct("place", "bits")).alias("hits"))
    joined = keyed.join(hits, ["id", "th"], "left").select("row", "text", "hits")
    schema = f"row {joined.schema['row'].dataType.simpleString()}, n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"
    kept = joined.mapInArrow(_keep, schema)
    names = [c for c in docs.columns if c != text]
    carried = F.struct(*[F.col(f"row.c{k}").alias(c) for k, c in zip([k for k, c in enumerate(docs.columns) if c != text], names)])
    return kept.select(carried.alias("document"), *RESULTS)
