"""Elias-Fano sequences of numpy arrays, searched for many values at once.

A non-decreasing sequence of n numbers below u keeps the low log2(u / n) bits of
each number packed, and the rest as a bit vector in which entry i sets bit
(number >> low) + i: about 2 + log2(u / n) bits a number. Counts of set bits up
to every 64-bit word make selection a binary search.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

_BYTE = np.arange(256)
_ONES = np.array([bin(b).count("1") for b in range(256)], np.int64)
# Place of the k-th set bit of a byte.
_SELECT = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for k in range(8)] for b in range(256)], np.int64)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the ``k``-th (from 0) set bit of each word."""
    rest, place = k.copy(), np.zeros(len(k), np.int64)
    byte = np.zeros(len(k), np.int64)
    open_ = np.ones(len(k), bool)
    for j in range(8):
        now = ((words >> np.uint64(8 * j)) & np.uint64(255)).astype(np.int64)
        ones = _ONES[now]
        here = open_ & (rest < ones)
        place[here] = 8 * j
        byte[here] = now[here]
        open_ &= ~here
        rest = np.where(open_, rest - ones, rest)
    return place + _SELECT[byte, np.minimum(rest, 7)]


class EliasFano:
    """``arrays`` is what to store: size, low bits, packed low parts, upper bits, counts of ones before each word."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.n, self.low = int(arrays["shape"][0]), int(arrays["shape"][1])
        self.lows, self.high, self.ones = arrays["lows"], arrays["high"], arrays["ones"]

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        """From non-decreasing ``uint64`` numbers."""
        n = len(values)
        top = int(values[-1]) if n else 0
        low = max(0, (top // max(1, n)).bit_length() - 1)
        lows = np.zeros(n * low // 64 + 2, np.uint64)
        if low and n:
            part = values & np.uint64((1 << low) - 1)
            at = np.arange(n, dtype=np.int64) * low
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(lows, word, part << shift)
            over = np.flatnonzero((at & 63) + low > 64)
            np.bitwise_or.at(lows, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros(((int(places[-1]) if n else 0) // 64 + 1) * 64, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(high).astype(np.int64)
        ones = (np.cumsum(counts) - counts).astype(np.uint32 if n < 1 << 32 else np.uint64)
        return cls({"shape": np.array([n, low], np.int64), "lows": lows, "high": high, "ones": ones})

    @cached_property
    def _zeros(self) -> np.ndarray:
        return np.arange(len(self.high), dtype=np.int64) * 64 - self.ones.astype(np.int64)

    def _place(self, i: np.ndarray) -> np.ndarray:
        """Bit of entry ``i`` in the upper bits."""
        word = np.searchsorted(self.ones, i.astype(self.ones.dtype), side="right") - 1
        return word * 64 + _select_in_word(self.high[word], i - self.ones[word].astype(np.int64))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        at = i * self.low
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        first = self.lows[word] >> shift
        second = np.where(shift > 0, self.lows[word + 1] << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return (first | second) & np.uint64((1 << self.low) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Numbers at places ``i``."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, np.uint64)
        return ((self._place(i) - i).astype(np.uint64) << np.uint64(self.low)) | self._low(i)

    def _before(self, upper: np.ndarray) -> np.ndarray:
        """How many entries have an upper part below ``upper``."""
        last = len(self.high) * 64 - self.n  # zeros there are
        out = np.full(len(upper), self.n, np.int64)
        inside = np.flatnonzero((upper > 0) & (upper <= last))
        k = upper[inside] - 1
        word = np.searchsorted(self._zeros, k, side="right") - 1
        place = word * 64 + _select_in_word(self.high[word] ^ _ALL, k - self._zeros[word])
        out[inside] = place - k
        out[upper <= 0] = 0
        return np.minimum(out, self.n)

    def successor(self, x: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """First place in ``[begin, end)`` with a number of at least ``x``; ``end`` if there is none."""
        x = np.asarray(x, np.uint64)
        begin = np.zeros(len(x), np.int64) if begin is None else begin
        end = np.full(len(x), self.n, np.int64) if end is None else end
        upper = (x >> np.uint64(self.low)).astype(np.int64)
        lo = np.maximum(begin, self._before(upper))
        hi = np.minimum(end, self._before(upper + 1))
        low = x & np.uint64((1 << self.low) - 1)
        # Entries between share their upper part, so only low parts are compared.
        lo = np.minimum(lo, end)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            below = self._low(mid) < low[open_]
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        return lo

    def find(self, x: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Place of ``x`` in ``[begin, end)``, or -1."""
        x = np.asarray(x, np.uint64)
        at = self.successor(x, begin, end)
        stop = np.full(len(x), self.n, np.int64) if end is None else end
        some = np.flatnonzero(at < stop)
        out = np.full(len(x), -1, np.int64)
        hit = self.get(at[some]) == x[some]
        out[some[hit]] = at[some[hit]]
        return out
