"""An FM-index over word sequences: a wavelet matrix with backward search, in numpy.

Made inside a task for one shard. All searches are batched: one call takes
many patterns a step further.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank queries on a sequence of small integers, one bit plane per level."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.planes, self.before, self.zeros = [], [], []
        values = values.astype(np.uint32)
        for level in reversed(range(bits)):
            one = (values >> np.uint32(level)) & np.uint32(1)
            padded = np.zeros((len(one) // 64 + 1) * 64, dtype=np.uint8)
            padded[:len(one)] = one
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.planes.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1])
            self.zeros.append(len(one) - int(one.sum()))
            values = np.concatenate((values[one == 0], values[one == 1]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the position beside it."""
        lo, hi = np.zeros(len(ends), dtype=np.int64), ends.astype(np.int64)
        for k in range(self.bits):
            one = ((symbols >> np.uint32(self.bits - 1 - k)) & np.uint32(1)).astype(bool)
            a, b = self._ones(k, lo), self._ones(k, hi)
            lo = np.where(one, self.zeros[k] + a, lo - a)
            hi = np.where(one, self.zeros[k] + b, hi - b)
        return hi - lo

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[k][word] + np.bitwise_count(self.planes[k][word] & mask)


class FMIndex:
    """Backward search for patterns of up to ``depth`` symbols in a sequence.

    ``text`` holds symbols from 1; 0 separates its parts. Suffixes are sorted
    by their first ``depth`` symbols, equal ones by position, which is all
    that intervals of patterns of that length need, and makes the first row of
    an interval the pattern's earliest place.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = text.astype(np.int64), depth
        self.rows = self._suffixes()
        sigma = int(text.max(initial=0)) + 1
        last = self.text[self.rows - 1]               # the symbol before each suffix (cyclic)
        self.bwt = WaveletMatrix(last, max(1, sigma.bit_length()))
        self.first = np.concatenate(([0], np.cumsum(np.bincount(self.text, minlength=sigma))))

    def _suffixes(self) -> np.ndarray:
        """Positions sorted by their first ``depth`` symbols, by doubling known prefixes."""
        n, rank, done = len(self.text), self.text, 1
        ranks = {1: rank}
        while done < self.depth:
            # join two known prefixes, the second as long as still needed
            step = min(done, self.depth - done)
            second = max(k for k in ranks if k <= step)
            tail = np.zeros(n, dtype=np.int64)
            tail[:max(0, n - done)] = ranks[second][done:] + 1
            key = rank * (int(tail.max(initial=0)) + 1) + tail
            _, rank = np.unique(key, return_inverse=True)
            rank = rank.ravel().astype(np.int64)
            done += second
            ranks[done] = rank
        return np.argsort(rank, kind="stable")

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Intervals of the patterns with one more symbol in front."""
        both = self.bwt.rank(np.concatenate((symbols, symbols)), np.concatenate((lo, hi)))
        start = self.first[symbols]
        return start + both[:len(lo)], start + both[len(lo):]

    def repeated(self, ends: np.ndarray):
        """Matching statistics against a threshold, for windows of the indexed text itself.

        ``ends`` are last positions of windows of ``depth`` symbols. Each is
        searched backwards while its interval holds another place than its
        own; a window whose matched length reaches ``depth`` is reported.
        Returns (window numbers, earliest position of each's sequence).
        """
        alive = np.arange(len(ends))
        symbols = self.text[ends]
        lo, hi = self.first[symbols], self.first[symbols + 1]
        for back in range(1, self.depth):
            keep = hi - lo > 1
            alive, lo, hi = alive[keep], lo[keep], hi[keep]
            if not len(alive):
                break
            lo, hi = self.extend(self.text[ends[alive] - back].astype(np.uint32), lo, hi)
        keep = hi - lo > 1
        return alive[keep], self.rows[lo[keep]]
