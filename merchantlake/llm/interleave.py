"""Merging the Burrows-Wheeler transforms of shards by iterative interleave refinement.

A shard is a set of strings, each closed by a terminator; its transform comes from sorting its own rotations. The merged
order of all shards is not sorted again: it starts as the shards one after the other, and every round moves each position
by its shard's last-to-first mapping in a stable pass over one symbol. After h rounds positions are in order of their
first h symbols. A block boundary that appears in round h + 1 separates two neighbours with h symbols in common, which
gives the common prefixes; runs of neighbours with at least the depth in common are the repeated intervals.
"""

from __future__ import annotations

import numpy as np

#: A byte that UTF-8 never holds.
TERMINATOR = 0xFF


def _layout(strings: list[bytes]):
    lengths = np.array([len(s) + 1 for s in strings], dtype=np.int64)
    text = np.frombuffer(b"".join(s + bytes([TERMINATOR]) for s in strings), dtype=np.uint8)
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(strings)), lengths)
    following = np.arange(1, len(text) + 1)
    following[starts + lengths - 1] = starts
    return text, starts, owner, following


def _sorted_shards(text: np.ndarray, shard: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Positions by shard and, within it, by rotation."""
    rank, jump = shard * 256 + text, following
    while True:
        key = rank * (int(rank.max()) + 1) + rank[jump]
        order = np.argsort(key, kind="stable")
        steps = np.diff(key[order], prepend=-1) != 0
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(steps) - 1
        if steps.all():
            return order
        jump = jump[jump]


def _shards(strings: list[bytes], shard_of: np.ndarray):
    """Owner and offset of every position, positions by shard and rotation, their transforms, and last-to-first steps."""
    text, starts, owner, following = _layout(strings)
    shard = np.asarray(shard_of, dtype=np.int64)[owner]
    places = _sorted_shards(text, shard, following)
    before = np.empty_like(following)
    before[following] = np.arange(len(text))
    transform = text[before[places]]
    step = np.empty(len(text), dtype=np.int64)
    step[np.argsort(shard[places] * 256 + transform, kind="stable")] = np.arange(len(text))
    return owner[places], places - starts[owner[places]], transform, step


def _round(merged: np.ndarray, block: np.ndarray, transform: np.ndarray, step: np.ndarray):
    """One stable pass: the new order, and where its blocks begin."""
    symbol = transform.take(merged)
    stable = symbol.argsort(kind="stable")
    symbol, block = symbol.take(stable), block.take(stable)
    begins = np.empty(len(merged), dtype=bool)
    begins[:1] = True
    np.not_equal(symbol[1:], symbol[:-1], out=begins[1:])
    begins[1:] |= block[1:] != block[:-1]
    return step.take(merged.take(stable)), begins


def merge(strings: list[bytes], shard_of: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, offset, common) of every position of the merged order.

    ``common`` is the length of the prefix shared with the position before, up to ``depth``. Strings must differ, and
    no string may hold the terminator.
    """
    owner, offset, transform, step = _shards(strings, shard_of)
    merged = np.arange(len(step))
    block = np.zeros(len(step), dtype=np.int64)
    common = np.full(len(step), depth, dtype=np.int64)
    common[:1], blocks = 0, 1
    for shared in range(depth):
        merged, begins = _round(merged, block, transform, step)
        common[begins & (common == depth)] = shared
        block = np.cumsum(begins) - 1
        # A round that splits nothing is followed by none that does.
        if block[-1] + 1 == blocks:
            break
        blocks = int(block[-1]) + 1
    return owner[merged], offset[merged], common


def repeated_intervals(strings: list[bytes], shard_of: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, offset, interval) of the positions that share ``depth`` symbols with another, interval by interval.

    The same rounds as in :func:`merge`. A position alone in its block has a prefix of its own, and so has, from the next
    round on, the position before it in its string: such positions are left out of further rounds.
    """
    owner, offset, transform, step = _shards(strings, shard_of)
    merged = np.arange(len(step))
    block, blocks = np.zeros(len(step), dtype=np.int64), 1
    for _ in range(depth):
        merged, begins = _round(merged, block, transform, step)
        alone = begins.copy()
        alone[:-1] &= begins[1:]
        block = np.cumsum(begins) - 1
        left_out = np.count_nonzero(alone)
        if not left_out and len(block) and block[-1] + 1 == blocks:
            break
        if 8 * left_out > len(merged):
            merged, block = merged[~alone], block[~alone]
            block = np.cumsum(np.diff(block, prepend=-1) != 0) - 1
        if not len(merged):
            break
        blocks = int(block[-1]) + 1
    alone = np.diff(block, prepend=-1) != 0
    alone[:-1] &= alone[1:]
    merged, block = merged[~alone], block[~alone]
    return owner[merged], offset[merged], block


def later_windows(strings: list[bytes], windows: np.ndarray, shard_of: np.ndarray, depth: int) -> np.ndarray:
    """(string, offset) of each of the first ``windows[string]`` offsets whose ``depth`` bytes occur in an earlier string."""
    owner, offset, interval = repeated_intervals(strings, shard_of, depth)
    counted = offset < windows[owner]
    owner, offset, interval = owner[counted], offset[counted], interval[counted]
    if not len(owner):
        return np.empty((0, 2), dtype=np.int64)
    begins = np.flatnonzero(np.diff(interval, prepend=-1) != 0)
    first = np.repeat(np.minimum.reduceat(owner, begins), np.diff(np.append(begins, len(owner))))
    later = np.flatnonzero(owner > first)
    return np.stack([owner[later], offset[later]], axis=1)
