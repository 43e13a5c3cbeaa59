"""Elias-Fano coding of a non-decreasing sequence, with vectorised access and successor search.

The low bits of each value are packed side by side.  The high bits are a bit string: a one for each value,
preceded by a zero for each step of the high part.  Totals of ones before each block of 256 bits find the k-th zero or one.
All arrays are plain and can be memory-mapped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ONES = np.array([[(b >> k & 1) for k in range(8)] for b in range(256)], np.uint8)
_BEFORE = np.cumsum(_ONES, 1)  # ones up to and with bit k
#: Place of the r-th one in a byte.
_SELECT = np.array([[int(np.searchsorted(_BEFORE[b], r + 1)) for r in range(8)] for b in range(256)], np.int64)
_WORDS = 4  # of 64 bits in a block


@dataclass
class EliasFano:
    count: int
    low_bits: int
    low: np.ndarray  # uint64
    high: np.ndarray  # uint64, whole blocks
    ones: np.ndarray  # int64: ones before each block, and all of them at the end

    @staticmethod
    def build(values: np.ndarray, universe: int) -> EliasFano:
        """``values`` are sorted unsigned integers below ``universe``."""
        values, n = values.astype(np.uint64), len(values)
        bits = max(0, (int(universe) // max(1, n)).bit_length() - 1)
        total = n + (int(universe) >> bits) + 2
        flags = np.zeros(-(-total // (64 * _WORDS)) * 64 * _WORDS, np.uint8)
        flags[(values >> np.uint64(bits)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high).reshape(-1, _WORDS).sum(1, dtype=np.int64))))
        packed = [np.zeros(0, np.uint8)]
        for a in range(0, n if bits else 0, 1 << 16):
            part = values[a : a + (1 << 16)]
            packed.append(np.packbits(((part[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
        packed = np.concatenate(packed)
        low = np.concatenate((packed, np.zeros(-len(packed) % 8 + 8, np.uint8))).view(np.uint64)
        return EliasFano(n, bits, low, high, ones)

    def low_at(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = shift > 64 - self.low_bits
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.low_bits) - 1)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th one or zero (from 0)."""
        before = self.ones if one else np.arange(len(self.ones)) * (64 * _WORDS) - self.ones
        block = np.searchsorted(before, k, "right") - 1
        rest = k - before[block]
        words = self.high.reshape(-1, _WORDS)[block]
        if not one:
            words = ~words
        within = np.cumsum(np.bitwise_count(words), 1, dtype=np.int64)
        word = (within <= rest[:, None]).sum(1)
        rows = np.arange(len(k))
        rest = rest - np.where(word > 0, within[rows, word - 1], 0)
        eight = np.ascontiguousarray(words[rows, word]).view(np.uint8).reshape(-1, 8)
        within = np.cumsum(np.bitwise_count(eight), 1, dtype=np.int64)
        byte = (within <= rest[:, None]).sum(1)
        rest = rest - np.where(byte > 0, within[rows, byte - 1], 0)
        return block * (64 * _WORDS) + word * 64 + byte * 8 + _SELECT[eight[rows, byte], rest]

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        return ((self._select(i, True) - i).astype(np.uint64) << np.uint64(self.low_bits)) | self.low_at(i)

    def _bucket(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places [low, high) of the entries whose high part is that of each value."""
        top = (values >> np.uint64(self.low_bits)).astype(np.int64)
        last = len(self.high) * 64 - self.count - 1  # zeros, less one
        inside, top = top <= last, np.minimum(top, last)
        bit = np.where(top > 0, self._select(np.maximum(top - 1, 0), False) + 1, 0)
        low = bit - top
        # the run of ones from there: to the end of its word at once, further by search
        room = 64 - (bit & 63)
        zeros = ~(self.high[np.minimum(bit >> 6, len(self.high) - 1)] >> (bit & 63).astype(np.uint64))
        run = np.bitwise_count((zeros & (~zeros + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        high = low + run
        long = np.flatnonzero(run >= room)
        high[long] = self._select(top[long], False) - top[long]
        return np.where(inside, low, self.count), np.where(inside, high, self.count)

    def _search(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first value not below each of ``values``, and where their bucket ends."""
        target = values & np.uint64((1 << self.low_bits) - 1)
        low, end = self._bucket(values)
        high = end.copy()
        going = np.flatnonzero(low < high)
        while len(going):
            middle = (low[going] + high[going]) >> 1
            less = self.low_at(middle) < target[going]
            low[going[less]] = middle[less] + 1
            high[going[~less]] = middle[~less]
            going = going[low[going] < high[going]]
        return low, end

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Places of the first value not below each of ``values`` (``count`` if there is none)."""
        return self._search(values.astype(np.uint64))[0]

    def find(self, values: np.ndarray) -> np.ndarray:
        """Places of ``values``, -1 where they don't occur."""
        values = values.astype(np.uint64)
        at, end = self._search(values)
        there = np.flatnonzero(at < end)
        equal = self.low_at(at[there]) == (values[there] & np.uint64((1 << self.low_bits) - 1))
        out = np.full(len(values), -1, np.int64)
        out[there[equal]] = at[there[equal]]
        return out

    def arrays(self) -> dict[str, np.ndarray]:
        return {"shape": np.array([self.count, self.low_bits], np.int64), "low": self.low, "high": self.high, "ones": self.ones}

    @staticmethod
    def of(arrays: dict[str, np.ndarray]) -> EliasFano:
        return EliasFano(int(arrays["shape"][0]), int(arrays["shape"][1]), arrays["low"], arrays["high"], arrays["ones"])
