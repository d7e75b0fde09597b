"""Hard-negative mining: rows of other labels that score nearly as high against an anchor as a row of its own label does.

Rows are packed into blocks, and every block meets every block of anchors, so that scores are matrix products. From a block
goes only what can count: for an anchor the best rows of its label, and, once these are known for the whole table, the best
rows of other labels below each. Each such score is packed into one key of 24 bytes: anchor, falling score, id. One shuffle
deals the keys out by anchor and sorts them within partitions (``repartition`` and ``sortWithinPartitions``: the DataFrame
form of ``repartitionAndSortWithinPartitions``, sorted by Spark instead of Python). An iterator over the sorted
stream opens a window at each of the first positives and emits the negatives that fall into the open windows; it
holds the windows of one anchor and at most a handful of tied negatives, never the rows of an anchor.

Defined results: a row with a null id, label or vector, or with a null or non-finite component, takes no part. Missing
components of a shorter vector are zero. Rows equal in id, label and vector are one row. Different rows may share an id:
each is an anchor of its own, none counts for an anchor with that id, and those on one side of an anchor's label that also
share a score with it count once for it. Scores are 64-bit integers (components beyond their range are
clamped to it, products wrap); ties go by id. An anchor without a positive gives no row, nor does a positive
with a negative score, whose window is empty. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantlake.llm.common import partitions, store

POSITIVES = NEGATIVES = 5
#: A negative's score is at least LOW percent of the positive's, and at most all of it.
LOW = 80
SCALE = 256
#: Rows and anchors that one matrix product is made of, and components of both at most.
BLOCK_ROWS = 1 << 13
BLOCK_CELLS = 1 << 21
#: Anchors of a block that are scored at once.
AT_ONCE = 1 << 8
#: Bytes of anchors' vectors that a task holds beside its rows.
HELD_BYTES = 1 << 26
#: An anchor's number: its block's digest, then its place in the block.
PLACE_BITS = 13
EXACT = 1 << 53
LAST = (1 << 63) - 1
LEAST = -1 << 63

PACKED = "b bigint, kind int, ids binary, labels binary, vectors binary"
KEY = np.dtype(">u8")
SIGN = np.uint64(1 << 63)


def usable(rows: DataFrame, vec_id: str, label: Column, vector: str) -> DataFrame:
    """(id, label, v) of the rows that take part; v is of integers."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    kept = rows.where(F.col(f"`{vec_id}`").isNotNull() & label.isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform(v, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("bigint"))
    return kept.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), label.cast("bigint").alias("label"), whole.alias("v"))


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """Integers in as few bytes as hold them all."""
    least, most = vectors.min(initial=0), vectors.max(initial=0)
    return vectors.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in blocks, one record each, in the order of their ids; rows that repeat in a block count once."""
    for batch in batches:
        lengths = np.diff(batch.column("v").offsets.to_numpy())
        begin = 0
        while begin < batch.num_rows:
            width = max(1, int(lengths[begin : begin + BLOCK_ROWS].max()))
            part = batch.slice(begin, max(1, min(BLOCK_ROWS, BLOCK_CELLS // width)))
            sizes = lengths[begin : begin + part.num_rows]
            begin += part.num_rows
            vectors = np.zeros((len(sizes), width), dtype=np.int64)
            vectors[np.arange(width) < sizes[:, None]] = part.column("v").flatten().to_numpy()
            ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, labels, vectors = ids[order], labels[order], vectors[order]
            if (ids[1:] == ids[:-1]).any():
                first = np.sort(np.unique(np.column_stack([ids, labels, vectors]), axis=0, return_index=True)[1])
                ids, labels, vectors = ids[first], labels[first], vectors[first]
            vectors = _narrow(vectors)
            held = [ids.tobytes(), labels.tobytes(), vectors.tobytes()]
            digest = int.from_bytes(hashlib.blake2b(b"".join(held), digest_size=8).digest(), "big") >> (PLACE_BITS + 1)
            columns = [pa.array([digest], pa.int64()), pa.array([vectors.itemsize], pa.int32()), *[pa.array([x], pa.binary()) for x in held]]
            yield pa.RecordBatch.from_arrays(columns, ["b", "kind", "ids", "labels", "vectors"])


def _products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of all anchors and rows, exact: by floating point where no sum can be rounded."""
    width = max(rows.shape[1], anchors.shape[1])
    rows, anchors = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (rows, anchors))
    most = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (rows, anchors)]
    if most[0] * most[1] * width < EXACT:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors @ rows.T


def _read(record: dict, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(record[prefix + c], dtype=np.int64) for c in ("ids", "labels"))
    vectors = np.frombuffer(record[prefix + "vectors"], dtype=f"i{record[prefix + 'kind']}")
    return ids, labels, vectors.reshape(len(ids), -1).astype(np.int64)


def _best(scores: np.ndarray, taken: np.ndarray, upto: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor and each of its limits, the first rows by falling score, then by place, of those that are ``taken``
    and score no more than the limit: (anchor, row) pairs. Places follow ids.
    """
    n = scores.shape[1]
    bits = max(1, int(n - 1).bit_length())
    if np.abs(scores).max(initial=0) >= 1 << (61 - bits):
        levels, scores = np.unique(scores, return_inverse=True)
        scores = scores.reshape(-1, n)
        upto = np.searchsorted(levels, upto, side="right") - 1
    keys = np.where(taken, (scores << bits) | (n - 1 - np.arange(n)), LEAST)
    keys.sort(axis=1)
    upto = np.clip(upto, LEAST >> bits, (LAST >> bits) - 1)
    pairs = []
    for k in range(upto.shape[1]):
        end = (keys < ((upto[:, k] + 1) << bits)[:, None]).sum(axis=1)
        at = end[:, None] - 1 - np.arange(count)
        key = np.where(at >= 0, np.take_along_axis(keys, np.maximum(at, 0), axis=1), LEAST)
        anchor, j = np.nonzero(key != LEAST)
        pairs.append(anchor * n + (n - 1 - (key[anchor, j] & ((1 << bits) - 1))))
    both = np.unique(np.concatenate(pairs))
    return both // n, both % n


def _keys(place: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Bytes that sort by anchor, falling score and id."""
    packed = np.empty((len(place), 3), dtype=KEY)
    packed[:, 0] = place.astype(np.uint64)
    packed[:, 1] = ~(scores.view(np.uint64) ^ SIGN)
    packed[:, 2] = ids.view(np.uint64) ^ SIGN
    return packed


def _unpacked(keys: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    packed = np.frombuffer(b"".join(keys.to_pylist()), dtype=KEY).astype(np.uint64).reshape(-1, 3)
    return packed[:, 0].astype(np.int64), (~packed[:, 1] ^ SIGN).view(np.int64), (packed[:, 2] ^ SIGN).view(np.int64)


def _records(keys: np.ndarray, same: bool) -> pa.RecordBatch:
    offsets = np.arange(0, 24 * (len(keys) + 1), 24, dtype=np.int32)
    column = pa.BinaryArray.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(keys.tobytes())])
    return pa.RecordBatch.from_arrays([column, pa.array(np.full(len(keys), same))], ["key", "same"])


PAIRS = "key binary, same boolean"


def _scorer(same: bool, count: int):
    """Pairs of a block of rows and a block of anchors that can count, as keys."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                record = batch.slice(k, 1).to_pylist()[0]
                ids, labels, vectors = _read(record, "")
                anchors, anchor_labels, anchor_vectors = _read(record, "a_")
                for begin in range(0, len(anchors), AT_ONCE):
                    own = slice(begin, begin + AT_ONCE)
                    scores = _products(vectors, anchor_vectors[own])
                    other = anchors[own, None] != ids
                    of_label = anchor_labels[own, None] == labels
                    if same:
                        taken, upto = of_label & other, np.full((len(scores), 1), LAST)
                    else:
                        upto = np.frombuffer(record["a_upto"], dtype=np.int64).reshape(len(anchors), -1)[own]
                        lowest = np.where(upto >= 0, upto, LAST).min(axis=1)
                        # The lowest score a window takes: 100 s >= LOW * lowest, in numbers that cannot overflow.
                        floor = lowest // 100 * LOW + -(-(lowest % 100 * LOW) // 100)
                        taken = ~of_label & other & (scores >= floor[:, None])
                    anchor, row = _best(scores, taken, upto, count)
                    if len(anchor):
                        place = (record["a_b"] << PLACE_BITS) | (anchor + begin)
                        yield _records(_keys(place, scores[anchor, row], ids[row]), same)

    return score


def _met(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of rows beside every block of anchors, as a product of partitions: tasks read the few anchors where they
    are stored. No copies of them are made and nothing is broadcast, so the driver holds none whatever their size.
    """
    size = anchors.agg(F.sum(F.octet_length("a_vectors"))).first()[0] or 0
    held = anchors.coalesce(max(1, -(-size // HELD_BYTES)))
    return blocks.repartition(partitions(blocks.sparkSession)).crossJoin(held.hint("shuffle_replicate_nl"))


def _first_positives(count: int):
    """Scores of the first rows of each anchor, in the order of the keys."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen, before = None, 0, None
        for batch in batches:
            found = []
            for anchor, score, id_ in zip(*(x.tolist() for x in _unpacked(batch.column("key")))):
                if anchor != last:
                    last, seen, before = anchor, 0, None
                if seen < count and (score, id_) != before:
                    seen, before = seen + 1, (score, id_)
                    found.append((anchor, score, id_))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["place", "score", "id"])

    return first


def _miner(positives: int, negatives: int):
    """Windows over the sorted pairs of each anchor. A repeated row gives equal keys, one after the other."""

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, opened, windows, tied, at, before = None, 0, [], [], None, None
        for batch in batches:
            found = []
            place, score, id_ = (x.tolist() for x in _unpacked(batch.column("key")))
            for p, s, i, same in zip(place, score, id_, batch.column("same").to_pylist()):
                if p != last:
                    last, opened, windows, tied, at, before = p, 0, [], [], None, None
                if (s, i, same) == before:
                    continue
                before = (s, i, same)
                if s != at:
                    at, tied = s, []
                    windows = [w for w in windows if w[2] < negatives and LOW * w[1] <= 100 * s]
                if same:
                    if opened < positives:
                        opened += 1
                        if s >= 0:
                            windows.append([i, s, 0])
                            for t in tied:
                                windows[-1][2] += 1
                                found.append((p, i, windows[-1][2], t, s, s))
                    continue
                if len(tied) < negatives:
                    tied.append(i)
                for w in windows:
                    if w[2] < negatives:
                        w[2] += 1
                        found.append((p, w[0], w[2], i, w[1], s))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["place", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return mine


MINED = "place bigint, positive_id bigint, rank bigint, negative_id bigint, positive_score bigint, negative_score bigint"


def _sorted_by_key(pairs: DataFrame) -> DataFrame:
    return pairs.repartition(partitions(pairs.sparkSession), F.substring("key", 1, 8)).sortWithinPartitions("key", "same")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: Column | str = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``is_anchor`` is a condition on ``id``.

    The label is a column or an expression over the input, as integers.
    """
    usable_rows = usable(rows, vec_id, F.col(f"`{label}`") if isinstance(label, str) else label, vector)
    blocks = store(usable_rows.mapInArrow(_pack, PACKED), "blocks")
    anchors = store(usable_rows.where(is_anchor).dropDuplicates().mapInArrow(_pack, PACKED), "anchors")
    sides = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns])

    own = _met(blocks, sides).mapInArrow(_scorer(True, positives), PAIRS)
    firsts = store(_sorted_by_key(own).mapInArrow(_first_positives(positives), "place bigint, score bigint, id bigint"), "positives")
    scores = firsts.groupBy("place").agg(F.collect_list("score").alias("s"))
    place = F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    of_block = scores.groupBy(F.shiftright("place", PLACE_BITS).alias("a_b")).agg(F.collect_list(F.struct(place.alias("k"), "s")).alias("limits"))
    limited = store(sides.join(of_block, "a_b").mapInArrow(_limits(positives), LIMITED), "limits")
    wrong = _met(blocks, limited).mapInArrow(_scorer(False, negatives), PAIRS)
    pairs = firsts.mapInArrow(_as_pairs, PAIRS).unionByName(wrong)
    mined = _sorted_by_key(pairs).mapInArrow(_miner(positives, negatives), MINED)
    named = mined.join(anchors.select("b", "ids").mapInArrow(_ids_of_places, "place bigint, anchor_id bigint"), "place")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


LIMITED = "a_b bigint, a_kind int, a_ids binary, a_labels binary, a_vectors binary, a_upto binary"


def _limits(count: int):
    """Blocks of anchors with the scores of their positives; where an anchor lacks some stands -1."""

    def limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, found in enumerate(batch.column("limits").to_pylist()):
                upto = np.full((len(batch.column("a_ids")[k].as_py()) // 8, count), -1, dtype=np.int64)
                for x in found:
                    upto[x["k"], : len(x["s"])] = x["s"]
                names = ["a_b", "a_kind", "a_ids", "a_labels", "a_vectors"]
                columns = [batch.column(c).slice(k, 1) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([upto.tobytes()], pa.binary())], [*names, "a_upto"])

    return limits


def _as_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _records(_keys(*(batch.column(c).to_numpy() for c in ("place", "score", "id"))), True)


def _ids_of_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            ids = np.frombuffer(r["ids"], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((r["b"] << PLACE_BITS) | np.arange(len(ids))), pa.array(ids)], ["place", "anchor_id"])
