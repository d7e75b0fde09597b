"""XXH64 of many slices of one byte buffer at once, with numpy."""

from __future__ import annotations

import numpy as np

# The primes of XXH64.
P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (
        11400714785074694791,
        14029467366897019727,
        1609587929392839161,
        9650029242287828579,
        2870177450012600261,
    )
)
STRIPE = 32
PADDING = bytes(8)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def _long_start(eight: np.ndarray, at: np.ndarray, stripes: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Accumulator after all whole stripes."""
    acc = [np.full(len(at), s) for s in (seed + P1 + P2, seed + P2, seed, seed - P1)]
    for k in range(int(stripes.max())):
        on = np.flatnonzero(stripes > k)
        for lane in range(4):
            acc[lane][on] = _round(acc[lane][on], eight[at[on] + k * STRIPE + lane * 8])
    out = sum(_rotl(a, r) for a, r in zip(acc, (1, 7, 12, 18)))
    for a in acc:
        out = (out ^ _round(np.zeros_like(a), a)) * P1 + P4
    return out


def xxh64_slices(data: bytes, starts: np.ndarray, lengths: np.ndarray, seed: int) -> np.ndarray:
    """Unsigned hashes of ``data[start : start + length]`` for every slice."""
    buffer = data + PADDING
    one = np.frombuffer(buffer, dtype=np.uint8)
    eight = np.ndarray((len(buffer) - 7,), dtype="<u8", buffer=buffer, strides=(1,))
    with np.errstate(over="ignore"):
        seed64 = np.uint64(seed)
        acc = np.full(len(starts), seed64 + P5)
        stripes = lengths // STRIPE
        long = np.flatnonzero(stripes)
        if len(long):
            acc[long] = _long_start(eight, starts[long], stripes[long], seed64)
        acc += lengths.astype(np.uint64)
        rest, at = lengths % STRIPE, starts + stripes * STRIPE
        for k in range(3):
            on = np.flatnonzero(rest >= 8 * (k + 1))
            mixed = acc[on] ^ _round(np.zeros(len(on), np.uint64), eight[at[on] + 8 * k])
            acc[on] = _rotl(mixed, 27) * P1 + P4
        at, rest = at + rest // 8 * 8, rest % 8
        on = np.flatnonzero(rest >= 4)
        four = eight[at[on]] & np.uint64(0xFFFFFFFF)
        acc[on] = _rotl(acc[on] ^ (four * P1), 23) * P2 + P3
        at, rest = at + rest // 4 * 4, rest % 4
        for k in range(3):
            on = np.flatnonzero(rest > k)
            acc[on] = _rotl(acc[on] ^ (one[at[on] + k].astype(np.uint64) * P5), 11) * P1
        acc = (acc ^ (acc >> np.uint64(33))) * P2
        acc = (acc ^ (acc >> np.uint64(29))) * P3
        return acc ^ (acc >> np.uint64(32))


def remixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """Another hash of the same slices for every ``k``; ``k`` zero leaves them as they are."""
    if not k:
        return hashes
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(k) * P1
        x = (x ^ (x >> np.uint64(33))) * P2
        x = (x ^ (x >> np.uint64(29))) * P3
        return x ^ (x >> np.uint64(32))
