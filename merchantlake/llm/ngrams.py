"""Hashed byte n-grams of many texts at once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from merchantlake.llm.common import batches_of_bytes, joined_bytes

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
TEXT_AT_ONCE = 1 << 20
NO_LETTERS = str.maketrans({c: " " for c in map(chr, range(128)) if not c.isalpha()})


def lowered(text: str | None) -> str:
    return (text or "").lower()


def _buckets(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each byte."""
    size = len(data) - n + 1
    h = np.full(size, n, dtype=np.uint64)
    for k in range(n):
        h = (h + data[k : k + size]) * MULTIPLIER
        h ^= h >> np.uint64(29)
    return (h * MULTIPLIER >> np.uint64(64 - bits)).astype(np.int64)


def counted(texts: list[str | None], sizes: tuple[int, ...], bits: int, prepare: Callable = lowered):
    """Yield (first text, texts, text of entry, bucket, count) for portions of ``texts``.

    Entries are sorted by text, with each bucket of a text once; n-grams never cross texts. The whole text counts.
    """
    for begin, end in batches_of_bytes(texts, TEXT_AT_ONCE):
        data, starts = joined_bytes([prepare(t) for t in texts[begin:end]])
        lengths = np.diff(starts)
        owner = np.repeat(np.arange(end - begin), lengths)
        keys = []
        for n in sizes:
            if len(data) >= n:
                inside = np.flatnonzero(np.arange(len(data) - n + 1) + n <= starts[1:][owner[: len(data) - n + 1]])
                keys.append((owner[inside] << bits) | _buckets(data, n, bits)[inside])
        entries, times = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
        yield begin, end - begin, entries >> bits, entries & ((1 << bits) - 1), times


def minimise(value_and_slope: Callable, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with a backtracking line search."""
    f, g = value_and_slope(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, used = -g, []
        for s, y in reversed(pairs):
            a = (s @ d) / (s @ y)
            used.append(a)
            d = d - a * y
        if pairs:
            s, y = pairs[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(pairs, reversed(used)):
            d = d + (a - (y @ d) / (s @ y)) * s
        step = 1.0 if pairs else 1.0 / max(1.0, float(np.abs(g).sum()))
        slope = g @ d
        while step > 1e-8:
            trial = x + step * d
            f_new, g_new = value_and_slope(trial)
            if f_new <= f + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = trial - x, g_new - g
        if s @ y > 1e-12:
            pairs = [*pairs[-memory + 1 :], (s, y)]
        done = f - f_new < 1e-7 * max(1.0, abs(f))
        x, f, g = trial, f_new, g_new
        if done:
            break
    return x
