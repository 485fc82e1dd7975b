"""An FM-index over words: wavelet matrix of the Burrows-Wheeler transform, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: Every so manieth position of the text is kept with its row, so locating walks at most that far.
SAMPLE = 16


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes. Each 0 is a symbol of its own, smaller than all others and ordered by
    position, so comparison ends at the next 0; by prefix doubling, in each round over what is still tied."""
    n = len(symbols)
    zeros = symbols == 0
    n_zero = int(zeros.sum())
    key = symbols.astype(np.int64) + n_zero
    key[zeros] = np.arange(n_zero)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.ones(n, dtype=bool)
    head[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = 1
    while True:
        tied = ~head
        tied[:-1] |= ~head[1:]
        rows = np.flatnonzero(tied)
        if not len(rows):
            return order
        at = order[rows]
        second = rank[np.minimum(at + step, n - 1)]
        first = rank[at]
        again = np.lexsort((second, first))
        at, first, second = at[again], first[again], second[again]
        order[rows] = at
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        head[rows] = new
        rank[at] = np.maximum.accumulate(np.where(new, rows, 0))
        step *= 2


class WaveletMatrix:
    """Ranks of symbols by one bit vector a level, for many queries at once."""

    def __init__(self, values: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        v = values
        for k in range(self.levels - 1, -1, -1):
            bit = (v >> k) & 1
            ones = np.zeros(len(v) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(v) - int(ones[-1]))
            v = np.concatenate([v[bit == 0], v[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        begin, end = np.zeros(len(at), dtype=np.int64), at.astype(np.int64)
        for depth, k in enumerate(range(self.levels - 1, -1, -1)):
            ones, zeros = self.ones[depth], self.zeros[depth]
            one = ((symbol >> k) & 1).astype(bool)
            b, e = ones[begin], ones[end]
            begin, end = np.where(one, zeros + b, begin - b), np.where(one, zeros + e, end - e)
        return end - begin


class FmIndex:
    """Symbols are from 1 to top; 0 stands between texts and at the end, and is in no pattern."""

    def __init__(self, symbols: np.ndarray, top: int):
        n = len(symbols)
        order = suffix_order(symbols)
        self.n = n
        self.bwt = symbols[order - 1].astype(np.int64)  # the symbol before position 0 is the 0 at the end
        self.matrix = WaveletMatrix(self.bwt, top)
        self.before = np.zeros(top + 2, dtype=np.int64)
        np.cumsum(np.bincount(symbols, minlength=top + 1), out=self.before[1:])
        # Rows behind a 0 are sampled too: no walk passes a 0, whose order is by position and not by what follows.
        self.sampled = (order % SAMPLE == 0) | (self.bwt == 0)
        self.position = np.where(self.sampled, order, -1)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pattern (a row, padded on the right) the range of rows whose suffixes begin with it."""
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.n, dtype=np.int64)
        for t in range(int(lengths.max()) if len(lengths) else 0):
            live = np.flatnonzero((lengths > t) & (low < high))
            c = patterns[live, lengths[live] - 1 - t]
            low[live] = self.before[c] + self.matrix.rank(c, low[live])
            high[live] = self.before[c] + self.matrix.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking back to the next sampled one."""
        rows = rows.copy()
        steps = np.zeros(len(rows), dtype=np.int64)
        open_ = np.flatnonzero(~self.sampled[rows])
        while len(open_):
            r = rows[open_]
            c = self.bwt[r]
            rows[open_] = self.before[c] + self.matrix.rank(c, r)
            steps[open_] += 1
            open_ = open_[~self.sampled[rows[open_]]]
        return self.position[rows] + steps
