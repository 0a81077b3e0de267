"""A compressed full-text index over word symbols, built and searched by array operations.

The Burrows-Wheeler transform of a collection of short word sequences is kept in a
wavelet matrix: one bit vector a bit of the symbols, with a count every 64 bits.
A backward search step is two ranks; all queries of a batch take it together.
Suffixes are sorted by their first ``depth`` symbols, which is all that patterns
up to that length can tell apart.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank: 1 bit and half a bit of counts for each place."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        room = np.zeros((n // 64 + 1) * 64, np.uint8)
        room[:n] = bits
        self.words = np.packbits(room, bitorder="little").view("<u8")
        each = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.concatenate([[0], np.cumsum(each[:-1], dtype=np.uint32)]).astype(np.uint32)
        self.ones = int(each.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each place ``i`` (0 to n)."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, top: int):
        """``symbols`` are 0 to ``top``."""
        self.levels = max(int(top).bit_length(), 1)
        self.bits, self.zeros = [], []
        v = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (v >> level) & 1
            self.bits.append(Bits(bit))
            self.zeros.append(len(v) - self.bits[-1].ones)
            v = np.concatenate([v[bit == 0], v[bit == 1]])
        every = np.arange(top + 1)
        self.origin = self._down(every, np.zeros(top + 1, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits, zeros in zip(range(self.levels - 1, -1, -1), self.bits, self.zeros):
            ones = bits.rank(i)
            i = np.where((symbol >> level) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before place ``i``."""
        return self._down(symbol, i) - self.origin[symbol]


class FMIndex:
    """Index of the sequences ``codes[first[k]:first[k + 1]]``; searched for stretches of ``window`` symbols.

    Attributes: ``rows`` (index row of every text place, sequences each followed by
    one separator), ``group`` (for every row, a number shared by rows whose
    next ``window`` symbols are the same).
    """

    def __init__(self, codes: np.ndarray, first: np.ndarray, window: int, depth: int):
        self.window, self.depth = window, max(depth, window)
        self.alphabet, symbol = np.unique(codes, return_inverse=True)
        ends = np.arange(len(first) - 1)
        self.place = np.arange(len(codes)) + np.repeat(ends, np.diff(first))  # of every code in the text
        text = np.zeros(len(codes) + len(ends), np.int64)
        text[self.place] = symbol.reshape(-1) + 1
        n, top = len(text), len(self.alphabet)
        rank, length, self.group = text, 1, None
        by_window = None

        def joined(by: int) -> np.ndarray:
            after = np.zeros(n, np.int64)
            after[:max(n - by, 0)] = rank[by:] + 1
            return np.unique(rank * (int(rank.max(initial=0)) + 2) + after, return_inverse=True)[1].reshape(-1)
        while True:
            if length <= window < 2 * length:
                by_window = joined(window - length) if window > length else rank
            if length >= self.depth:
                break
            rank, length = joined(length), 2 * length
        order = np.argsort(rank, kind="stable")
        self.rows = np.empty(n, np.int64)
        self.rows[order] = np.arange(n)
        self.order, self.group = order, by_window[order]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.tree = WaveletMatrix(text[order - 1], top)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of word codes, 0 for a word that the index does not hold."""
        if not len(self.alphabet):
            return np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at + 1, 0)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of symbol + pattern from the rows [low, high) of each pattern: one backward step."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.start[symbol]
        known = symbol > 0
        k = len(symbol)
        return np.where(known, base + both[:k], 0), np.where(known, base + both[k:], 0)

    def statistics(self, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the sequences ``codes[first[k]:first[k + 1]]``, all searched together.

        For every place: (symbols of the longest match that begins there, counted to
        the ``window`` at most; a row of the index whose text begins with that
        window, -1 where the match is shorter).  From right to left a match is
        carried on by one symbol; where that fails, the window one place further
        left is searched anew.  No match is carried beyond ``depth`` symbols.
        """
        symbol, n = self.symbols(codes), len(self.rows)
        length, row = np.zeros(len(codes), np.int64), np.full(len(codes), -1, np.int64)
        lane = np.flatnonzero(np.diff(first) > 0)
        begin, at = first[lane], first[lane + 1] - 1
        end = at.copy()                                     # last symbol of the pattern
        low, high = np.zeros(len(lane), np.int64), np.full(len(lane), n, np.int64)
        while len(at):
            a, z = self.extend(symbol[at], low, high)
            ok = (a < z) & (end - at < self.depth)
            good = at[ok]
            size = end[ok] - good + 1
            length[good] = np.maximum(length[good], np.minimum(size, self.window))
            whole = size >= self.window
            row[good[whole]] = a[ok][whole]
            # failed: the place ``at`` starts no match that reaches ``end``; look at one that ends earlier
            grown = end - at >= self.window                 # the window at ``at`` itself is still open
            new_end = np.where(grown, at + self.window - 1, end - 1)
            low, high = np.where(ok, a, 0), np.where(ok, z, n)
            end = np.where(ok, end, new_end)
            at = np.where(ok, at - 1, end)
            # a match that has reached its text's begin still hides shorter ones at places not yet settled: none,
            # as every place right of it was the begin of a longer match when it was passed
            live = at >= begin
            at, end, low, high, begin = at[live], end[live], low[live], high[live], begin[live]
        return length, row
