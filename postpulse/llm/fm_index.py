"""Compressed full-text index over numbers: suffix order, wavelet matrix, backward search of many patterns at once."""

from __future__ import annotations

import numpy as np

#: Patterns may be this long at most, unless the index is given another depth; suffixes are sorted no further.
DEPTH = 128


def suffix_order(text: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Positions of ``text`` in the order of their next ``depth`` symbols, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    while step < depth and n > 1:
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order[1:]] != key[order[:-1]])))
        rank[order] = new
        step *= 2
        if new[-1] == n - 1:
            break
    return order


class WaveletMatrix:
    """One bit vector for each bit of the symbols, packed in words with a count before each."""

    def __init__(self, values: np.ndarray):
        self.levels = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.words, self.before, self.zeros = [], [], []
        n = len(values)
        for level in range(self.levels):
            bits = (values >> (self.levels - 1 - level)) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            packed = np.concatenate((packed, np.zeros(16 - len(packed) % 8, np.uint8))).view(np.uint64)
            self.words.append(packed)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64))))
            self.zeros.append(n - int(bits.sum()))
            values = np.concatenate((values[bits == 0], values[bits == 1]))
        # Where symbols begin in the order of the last level.
        self.base = self.walk(np.arange(1 << self.levels), np.zeros(1 << self.levels, np.int64))

    def walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            word = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[level][word] + np.bitwise_count(self.words[level][word] & mask)
            at = np.where((symbols >> (self.levels - 1 - level)) & 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before its position."""
        return self.walk(symbols, at) - self.base[symbols]


class FMIndex:
    """Index of ``text`` (symbols from 1, 0 between passages) whose positions have an ``owner``."""

    def __init__(self, text: np.ndarray, owner: np.ndarray, depth: int = DEPTH):
        order = suffix_order(text, depth)
        self.size = len(text)
        self.bwt = WaveletMatrix(text[order - 1])
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=1 << self.bwt.levels))))
        # Smallest owner of ranges that are powers of two long.
        self.least = [owner[order]]
        while 2 << (len(self.least) - 1) <= self.size:
            last, half = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-half], last[half:]))

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges after one more symbol to the left."""
        return self.first[symbols] + self.bwt.rank(symbols, lo), self.first[symbols] + self.bwt.rank(symbols, hi)

    def smallest_owner(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of ranges that aren't empty."""
        out = np.empty(len(lo), self.least[0].dtype)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            table = self.least[k]
            out[own] = np.minimum(table[lo[own]], table[hi[own] - (1 << int(k))])
        return out


def matching_windows(index: FMIndex, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, owners: np.ndarray, window: int, probe: int = 8):
    """Streams passages of ``text`` through the index: (passage, from, to) of maximal stretches of ``window`` symbols or more
    that also occur under a smaller owner. All passages advance together, one symbol at a time.

    Matches are followed from their right end to the left. Where one ends, the next right end follows from it; a short probe
    around the place shows whether all windows across it can be skipped.
    """
    n = len(starts)
    found = []
    end, at = sizes.astype(np.int64).copy(), sizes.astype(np.int64).copy()
    lo, hi = np.zeros(n, np.int64), np.full(n, index.size, np.int64)
    probing, spot = np.zeros(n, bool), np.zeros(n, np.int64)
    live = np.flatnonzero(end >= window)
    while len(live):
        symbols = text[starts[live] + at[live] - 1]
        a, b = index.extend(symbols, lo[live], hi[live])
        good = b > a
        if good.any():
            good[good] = index.smallest_owner(a[good], b[good]) < owners[live[good]]
        yes, no = live[good], live[~good]
        lo[yes], hi[yes] = a[good], b[good]
        at[yes] -= 1
        # A probe that reaches its place says nothing; a match that reaches the start is complete.
        passed = yes[probing[yes] & (at[yes] <= spot[yes])]
        whole = yes[~probing[yes] & (at[yes] == 0)]
        found += [(i, 0, int(end[i])) for i in whole.tolist() if end[i] >= window]
        end[whole] = 0
        failed = no[~probing[no]]
        for i in failed[end[failed] - at[failed] >= window].tolist():
            found.append((i, int(at[i]), int(end[i])))
        # The symbol at ``spot`` stopped the match.
        spot[failed] = at[failed] - 1
        # No window that ends further right may still cross the spot.
        end[failed] = np.minimum(end[failed], spot[failed] + window + 1)
        probing[failed] = True
        stopped = no[probing[no] & ~np.isin(no, failed)]
        # Nothing with [at - 1, spot + probe) matches: the next window ends before that.
        end[stopped] = np.minimum(end[stopped] - 1, spot[stopped] + probe - 1)
        end[passed] -= 1
        fresh = np.concatenate((passed, stopped))
        probing[fresh] = False
        at[fresh] = end[fresh]
        at[failed] = np.minimum(end[failed], spot[failed] + probe)
        changed = np.concatenate((fresh, failed))
        lo[changed], hi[changed] = 0, index.size
        live = live[end[live] >= window]
    return found
