"""FM-index over the word sequences of one shard: suffix order, Burrows-Wheeler transform in a wavelet
matrix, backward search of many phrases at once and location by sampled suffix positions.

Symbols are positive integers; 0 ends a run.  Each end counts as a symbol of its own, smaller than any
word, so no phrase crosses a run and equal runs don't lengthen the sort.
"""

from __future__ import annotations

import numpy as np


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the ends of runs are distinct, so the longest run bounds the rounds."""
    n = len(seq)
    ends = seq == 0
    rank = np.where(ends, np.cumsum(ends) - 1, int(ends.sum()) + seq.astype(np.int64))
    step = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (int(rank.max()) + 2 + n) + ahead
        key[ends] = rank[ends] * (int(rank.max()) + 2 + n)
        order = np.argsort(key, kind="stable")
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = key[order[1:]] != key[order[:-1]]
        classes = np.cumsum(new)
        rank = np.empty(n, np.int64)
        rank[order] = classes
        if classes[-1] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of any symbol at any position, in one step for each bit of the alphabet."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.bits)):
            bit = (seq >> level) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self.first = self._place(np.arange(symbols + 1), np.zeros(symbols + 1, np.int64))

    def _place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros):
            before = ones[at]
            at = np.where((symbol >> level) & 1, zeros + before, at - before)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol[i]`` occurs before position ``at[i]``."""
        return self._place(symbol, at) - self.first[symbol]


class FMIndex:
    def __init__(self, seq: np.ndarray, symbols: int, sample: int = 16):
        order = suffix_order(seq)
        self.last = seq[order - 1]  # of position 0: the end of the last run, which is 0
        self.below = np.zeros(symbols + 2, np.int64)
        np.cumsum(np.bincount(seq, minlength=symbols + 1), out=self.below[1:])
        self.tree = WaveletMatrix(self.last, symbols)
        known = (order % sample == 0) | (self.last == 0)
        self.known, self.samples = known, order[known]
        self.nth = np.cumsum(known) - 1
        self.n = len(seq)

    def back(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.below[symbol] + self.tree.rank(symbol, at)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the phrases: right-aligned rows of symbols, 0 before a shorter phrase."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        for column in reversed(range(phrases.shape[1])):
            live = np.flatnonzero((phrases[:, column] > 0) & (low < high))
            symbol = phrases[live, column]
            low[live], high[live] = self.back(symbol, low[live]), self.back(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: walk back to a sampled one."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        while len(todo := np.flatnonzero(~self.known[at])):
            at[todo] = self.back(self.last[at[todo]], at[todo])
            steps[todo] += 1
        return self.samples[self.nth[at]] + steps
