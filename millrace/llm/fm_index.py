"""An FM-index over integer sequences: wavelet ranks and sampled suffixes."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by doubling sorted prefixes."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    span = 1
    while n > 1:
        second = np.zeros(n, np.int64)
        if span < n:
            second[:-span] = rank[span:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            break
        span *= 2
    return order


class WaveletMatrix:
    """Ranks of symbols in prefixes, one bit of the symbol a level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        for level in reversed(range(self.bits)):
            zero = (sequence >> level) & 1 == 0
            before = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.zeros.append(before)
            sequence = np.concatenate([sequence[zero], sequence[~zero]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        lo, hi = np.zeros(len(at), np.int64), at.astype(np.int64)
        for level, before in zip(reversed(range(self.bits)), self.zeros, strict=True):
            one = (symbol >> level) & 1 == 1
            lo0, hi0 = before[lo], before[hi]
            lo = np.where(one, before[-1] + lo - lo0, lo0)
            hi = np.where(one, before[-1] + hi - hi0, hi0)
        return hi - lo


class FMIndex:
    """Index of a sequence of symbols from 1 up to ``symbols`` - 1."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8):
        text = np.concatenate([text, [0]]).astype(np.int64)
        order = suffix_array(text)
        self.bwt = text[order - 1]
        self.ranks = WaveletMatrix(self.bwt, symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.sampled = order % sample == 0
        self.kept = order[self.sampled]
        self.place = np.cumsum(self.sampled) - 1
        self.size = len(text)

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.ranks.rank(symbol, at)

    def search(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of all phrases flat[starts[i]:ends[i]], none of them empty."""
        last = flat[ends - 1]
        lo, hi = self.first[last], self.first[last + 1]
        live = np.flatnonzero((lo < hi) & (ends - 1 > starts))
        end = (ends[live] - 1).astype(np.int64)
        while len(live):
            end -= 1
            symbol = flat[end]
            lo[live], hi[live] = self._step(symbol, lo[live]), self._step(symbol, hi[live])
            more = (lo[live] < hi[live]) & (end > starts[live])
            live, end = live[more], end[more]
        return lo, np.maximum(lo, hi)

    def locate(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, text position) of every occurrence, from the nearest sample."""
        count = hi - lo
        phrase = np.repeat(np.arange(len(lo)), count)
        row = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        steps = np.zeros(len(row), np.int64)
        live = np.flatnonzero(~self.sampled[row])
        while len(live):
            row[live] = self._step(self.bwt[row[live]], row[live])
            steps[live] += 1
            live = live[~self.sampled[row[live]]]
        return phrase, self.kept[self.place[row]] + steps
