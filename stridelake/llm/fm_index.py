"""A small FM-index over integer sequences, vectorised over its queries.

The index holds the Burrows-Wheeler transform as a wavelet tree (one bit plane
per symbol bit, with running counts) and every k-th suffix position. Backward
search narrows all patterns at once, one symbol a step, by two ranks each.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; ``text`` ends with a unique smallest symbol."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    while step < n:
        second = np.zeros(n, dtype=np.int64)
        second[: n - step] = rank[step:] + 1
        joint = rank * (n + 1) + second
        order = np.argsort(joint, kind="stable")
        ordered = joint[order]
        fresh = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank[order] = fresh
        if fresh[-1] == n - 1:
            break
        step *= 2
    return order


class WaveletTree:
    """Rank of a symbol in a prefix, by one bit plane per level (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, n_bits: int):
        self.n_bits, self.ones, self.zeros = n_bits, [], []
        now = symbols
        for level in reversed(range(n_bits)):
            bit = (now >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate((now[bit == 0], now[bit == 1]))

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        lo, hi = np.zeros_like(upto), upto
        for k, level in enumerate(reversed(range(self.n_bits))):
            ones = self.ones[k]
            up = ((symbol >> level) & 1).astype(bool)
            lo_ones, hi_ones = ones[lo], ones[hi]
            lo = np.where(up, self.zeros[k] + lo_ones, lo - lo_ones)
            hi = np.where(up, self.zeros[k] + hi_ones, hi - hi_ones)
        return hi - lo

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and its rank there."""
        lo, hi, symbol = np.zeros_like(at), at, np.zeros_like(at)
        for k in range(self.n_bits):
            ones = self.ones[k]
            up = (ones[hi + 1] - ones[hi]).astype(bool)
            lo_ones, hi_ones = ones[lo], ones[hi]
            symbol = symbol * 2 + up
            lo = np.where(up, self.zeros[k] + lo_ones, lo - lo_ones)
            hi = np.where(up, self.zeros[k] + hi_ones, hi - hi_ones)
        return symbol, hi - lo


class FMIndex:
    """Index of a sequence of symbols of 1 or more; 0 is added as its end."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        text = np.concatenate((symbols.astype(np.int64), [0]))
        order = suffix_array(text)
        last = text[order - 1]
        n_symbols = int(text.max()) + 1
        self.n = len(text)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))))
        self.tree = WaveletTree(last, max(1, (n_symbols - 1).bit_length()))
        self.kept = order % sample == 0
        self.kept_rank = np.concatenate(([0], np.cumsum(self.kept)))
        self.position = order[self.kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval [lo, hi) of each pattern, a row padded on the right."""
        lo = np.zeros(len(patterns), dtype=np.int64)
        hi = np.full(len(patterns), self.n, dtype=np.int64)
        top = len(self.below) - 1
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= back) & (hi > lo))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - back]
            known = symbol < top
            hi[live[~known]] = lo[live[~known]]
            live, symbol = live[known], symbol[known]
            lo[live] = self.below[symbol] + self.tree.rank(symbol, lo[live])
            hi[live] = self.below[symbol] + self.tree.rank(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, text position) of every occurrence, by sampled suffixes."""
        counts = hi - lo
        owner = np.repeat(np.arange(len(lo)), counts)
        rows = np.repeat(lo, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        found, steps = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        open_rows = np.arange(len(rows))
        while len(open_rows):
            at = rows[open_rows]
            done = self.kept[at]
            hit = open_rows[done]
            found[hit] = self.position[self.kept_rank[rows[hit]]] + steps[hit]
            open_rows = open_rows[~done]
            symbol, before = self.tree.access(rows[open_rows])
            rows[open_rows] = self.below[symbol] + before
            steps[open_rows] += 1
        return owner, found
