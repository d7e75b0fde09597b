"""A compressed FM-index over short sequences of integers, and matching statistics by backward search.

The Burrows-Wheeler transform of all sequences is held in a wavelet tree whose codes are as long as a symbol is rare (Shannon
code lengths, canonical codes), as one bit vector with a count for every 64 bits. Ranks are taken for many
positions at once, a level of the tree at a time.
"""

from __future__ import annotations

import numpy as np

WORD = 64
#: Three symbols are packed into one number for the first sort.
SYMBOL_BITS = 21


class _Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // WORD + 1) * WORD, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class WaveletTree:
    """Ranks of symbols in a sequence. Every symbol from 0 to the largest must occur."""

    def __init__(self, sequence: np.ndarray):
        counts = np.bincount(sequence)
        length = np.maximum(1, np.ceil(np.log2(len(sequence) / counts))).astype(np.int64)
        order = np.argsort(length, kind="stable")  # canonical: short codes first, of equal length by symbol
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.length = length[order]
        depth = int(self.length[-1])
        left = np.zeros(len(order), dtype=np.int64)  # codes, with zeros after them
        np.cumsum(1 << (depth - self.length[:-1]), out=left[1:])
        self.place, self.left, self.depth = place, left, depth
        before = np.concatenate([[0], np.cumsum(counts[order])])
        alive = np.searchsorted(self.length, np.arange(depth + 1), side="right")  # symbols with codes longer than a level
        # Where the node of a symbol begins at each level, among the bits of all levels.
        self.begin = np.zeros((depth, len(order)), dtype=np.int64)
        level = 0
        for t in range(depth):
            prefix = left >> (depth - t)
            first = np.searchsorted(prefix[alive[t] :], prefix, side="left") + alive[t]
            self.begin[t] = level + before[first] - before[alive[t]]
            level += len(sequence) - before[alive[t]]
        symbols, bits = place[sequence], np.empty(level, dtype=np.uint8)
        at = self.begin[0][symbols] + np.arange(len(symbols)) if depth else symbols
        for t in range(depth):
            # ``symbols`` stand in the order of this level's nodes, at places ``at``.
            bit = (left[symbols] >> (depth - 1 - t)) & 1
            bits[at] = bit
            if t + 1 == depth:
                break
            start = self.begin[t][symbols] - at[0]
            ones = np.cumsum(bit) - bit
            ones -= ones[start]
            zeros = np.arange(len(symbols)) - start - ones
            goes_on = np.flatnonzero(symbols >= alive[t + 1])
            symbols, rank = symbols[goes_on], np.where(bit, ones, zeros)[goes_on]
            to = self.begin[t + 1][symbols] + rank
            if not len(to):
                break
            low = to.min()
            sorted_ = np.empty(len(to), dtype=np.int64)
            sorted_[to - low] = symbols
            symbols, at = sorted_, low + np.arange(len(to))
        self.bits = _Bits(bits)
        self.ones = self.bits.rank(self.begin.ravel()).reshape(self.begin.shape)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        place = self.place[symbol]
        left, at = self.left[place], at.copy()
        which = np.arange(len(place))
        length = self.length[place]
        for t in range(self.depth):
            if t and (length[which] <= t).any():
                which = which[length[which] > t]
            if not len(which):
                break
            own, here = place[which], at[which]
            ones = self.bits.rank(self.begin[t][own] + here) - self.ones[t][own]
            at[which] = np.where((left[which] >> (self.depth - 1 - t)) & 1, ones, here - ones)
        return at

    def bytes(self) -> int:
        return self.bits.words.nbytes + self.bits.before.nbytes


def _sorted_suffixes(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Suffix order of sequences that end in symbols of their own, of ``longest`` symbols at most: by doubling."""
    n = len(symbols)
    ahead = np.zeros(n + 3, dtype=np.int64)
    ahead[:n] = symbols
    key = (ahead[:n] << (2 * SYMBOL_BITS)) | (ahead[1 : n + 1] << SYMBOL_BITS) | ahead[2 : n + 2]
    width = 3
    while True:
        order = np.argsort(key, kind="stable")
        if width >= longest:
            return order
        ranked = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.diff(ranked, prepend=ranked[:1]) != 0)
        if rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, dtype=np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + after
        width *= 2


class FMIndex:
    """An index of sequences that belong to owners, numbered in corpus order.

    ``words`` holds all sequences in a row as numbers from 0 with none left out, ``ends`` the end of each.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray, owner: np.ndarray, cap: int):
        self.cap, count = cap, len(ends)
        lengths = np.diff(ends, prepend=0)
        own = np.repeat(np.arange(count), lengths)
        places = np.arange(len(words)) + own
        n = len(words) + count
        symbols = np.empty(n, dtype=np.int64)
        symbols[places] = words + count
        closed = ends + np.arange(count)
        symbols[closed] = np.arange(count)  # each sequence ends in a symbol of its own, before all words
        order = _sorted_suffixes(symbols, int(lengths.max()) + 1)
        folded = np.where(symbols < count, 0, symbols - count + 1)
        self.tree = WaveletTree(folded[order - 1])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(folded))])
        self.n = n
        self._intervals(symbols, order, np.repeat(owner, lengths + 1)[order])

    def _intervals(self, symbols: np.ndarray, order: np.ndarray, owner: np.ndarray) -> None:
        """For each length up to the cap: which suffixes agree in so many symbols, and the first owner among them."""
        padded = np.append(symbols, np.full(self.cap, -1))
        equal = np.ones(len(order) - 1, dtype=bool)
        self.run, self.begin, self.earliest = [], [], []
        for k in range(self.cap + 1):
            new = np.append(True, ~equal)
            begin = np.flatnonzero(new)
            self.run.append((np.cumsum(new) - 1).astype(np.int32))
            self.begin.append(np.append(begin, len(order)))
            self.earliest.append(np.minimum.reduceat(owner, begin))
            at = order + k if k < self.cap else order
            equal = equal & (padded[np.minimum(at[1:], len(padded) - 1)] == padded[np.minimum(at[:-1], len(padded) - 1)])

    def matching_statistics(self, words: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """For each place of some sequences, how many words from there on, up to the cap, occur in sequences of earlier owners.

        All sequences are searched together, from their last word to their first.
        """
        starts = np.append(0, ends[:-1])
        found = np.zeros(len(words), dtype=np.int8)
        at = ends - 1
        low, high = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), self.n)
        size = np.zeros(len(ends), dtype=np.int64)
        live = np.flatnonzero(at >= starts)
        while len(live):
            full = live[size[live] == self.cap]
            self._shorten(full, low, high, size)
            symbol = words[at[live]] + 1
            k = len(live)
            ranks = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low[live], high[live]]))
            lo, hi = self.first[symbol] + ranks[:k], self.first[symbol] + ranks[k:]
            longer = size[live] + 1
            good = lo < hi
            for length in np.unique(longer[good]):
                those = np.flatnonzero(good & (longer == length))
                good[those] = self.earliest[length][self.run[length][lo[those]]] < owner[live[those]]
            on, off = live[good], live[~good]
            low[on], high[on], size[on] = lo[good], hi[good], longer[good]
            found[at[on]] = size[on]
            at[on] -= 1
            # What did not occur may do so without its last word; without any word, nothing begins here.
            none = off[size[off] == 0]
            at[none] -= 1
            self._shorten(off[size[off] > 0], low, high, size)
            live = live[at[live] >= starts[live]]
        return found

    def _shorten(self, which: np.ndarray, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> None:
        """Drop the last word of what has been matched: the interval of suffixes that agree in one symbol less."""
        for length in np.unique(size[which]):
            those = which[size[which] == length]
            run = self.run[length - 1][low[those]]
            low[those], high[those] = self.begin[length - 1][run], self.begin[length - 1][run + 1]
            size[those] = length - 1
