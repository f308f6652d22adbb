"""FM-index over a sequence of integers, for many short patterns at once.

The Burrows-Wheeler transform of the sequence is kept in a wavelet matrix: per
bit of the symbols one row of counts, so the rank of a symbol takes one lookup
per bit. Backward search narrows the rows of all patterns together; matching rows
walk back to the nearest sampled suffix position.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8  # every eighth position of the sequence is kept


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order; a shorter prefix comes first.

    Sorts by a few symbols, then doubles their number, for tied suffixes only.
    """
    n = len(symbols)
    base = int(symbols.max(initial=0)) + 2
    length = 3 if base**3 < 1 << 62 else 2  # as many as fit in one key
    padded = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(length, np.int64)])
    key = padded[:n].copy()
    for ahead in range(1, length):
        key = key * base + padded[ahead : n + ahead]
    order = np.argsort(key, kind="stable")
    # The rank of a suffix is the row where its group of ties begins.
    starts = _group_starts(key[order])
    rank = np.empty(n, np.int64)
    rank[order] = starts
    tied = _tied_rows(starts)
    while len(tied):
        suffixes = order[tied]
        after = suffixes + length
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[suffixes]
        by = np.lexsort((second, first))
        suffixes, first, second = suffixes[by], first[by], second[by]
        order[tied] = suffixes
        new = np.ones(len(tied), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        starts = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        rank[suffixes] = starts
        tied = tied[_tied_rows(starts)]
        length *= 2
    return order


def _group_starts(keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))


def _tied_rows(starts: np.ndarray) -> np.ndarray:
    same = np.zeros(len(starts) + 1, bool)
    same[1:-1] = starts[1:] == starts[:-1]
    return np.flatnonzero(same[1:] | same[:-1])


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray):
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            counts = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=counts[1:])
            self.ones.append(counts)
            self.zeros.append(len(symbols) - int(counts[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its row."""
        start = np.zeros(len(rows), np.int64)
        end = rows.astype(np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            high = ((symbols >> (self.bits - 1 - level)) & 1).astype(bool)
            first, last = ones[start], ones[end]
            start = np.where(high, zeros + first, start - first)
            end = np.where(high, zeros + last, end - last)
        return end - start


class FMIndex:
    """Over non-negative symbols; the sequence gets an end of its own."""

    def __init__(self, sequence: np.ndarray):
        text = np.append(sequence.astype(np.int64) + 1, 0)
        order = suffix_array(text)
        self.bwt = text[order - 1]
        self.wavelet = WaveletMatrix(self.bwt)
        self.largest = int(text.max())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text))])  # smaller symbols
        self.sampled = order % SAMPLE == 0
        self.samples = order[self.sampled]
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])

    def _back(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.before[symbols] + self.wavelet.rank(symbols, rows)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of every pattern, a row of symbols filled up on the left."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.bwt), np.int64)
        width = patterns.shape[1]
        for step in range(width):
            live = np.flatnonzero((low < high) & (lengths > step))
            if not len(live):
                break
            symbols = patterns[live, width - 1 - step].astype(np.int64) + 1
            known = symbols <= self.largest
            high[live[~known]] = low[live[~known]]
            live, symbols = live[known], symbols[known]
            low[live] = self._back(symbols, low[live])
            high[live] = self._back(symbols, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the sequence of the suffix in each row."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            at = rows[walking]
            rows[walking] = self._back(self.bwt[at], at)
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.samples[self.sample_rank[rows]] + steps
