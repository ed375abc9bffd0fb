"""Elias-Fano code of a rising sequence, with select samples, over NumPy arrays.

Of each number the low bits are stored as they are and the high bits as gaps in unary: about
``2 + log2(top / n)`` bits a number.  A sample of every 256th set bit lets a look-up start near its
place, so single offsets are found without unpacking the sequence.
"""

from __future__ import annotations

import numpy as np

EVERY = 256  # set bits between two select samples


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """Code of whole numbers from 0 on that never fall."""
        values = np.asarray(values, np.int64)
        n = len(values)
        if n == 0:
            return cls(0, 0, np.empty(0, np.uint8), np.empty(0, np.uint8), np.empty(0, np.uint32))
        if values[0] < 0 or (np.diff(values) < 0).any():
            raise ValueError("the sequence must start at 0 or above and never fall")
        low_bits = max(0, int(values[-1] // n).bit_length() - 1)
        rest = values & ((1 << low_bits) - 1)
        bits = ((rest[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        at = (values >> low_bits) + np.arange(n)
        flags = np.zeros(int(at[-1]) + 1, np.uint8)
        flags[at] = 1
        return cls(n, low_bits, low, np.packbits(flags, bitorder="little"), at[::EVERY].astype(np.uint32))

    def select(self, first: int, last: int) -> np.ndarray:
        """The numbers at the places from ``first`` to before ``last``."""
        if not 0 <= first <= last <= self.n:
            raise IndexError(f"{first}:{last} of {self.n}")
        if first == last:
            return np.empty(0, np.int64)
        block = first // EVERY
        start = int(self.samples[block])
        behind = (last - 1) // EVERY + 1
        stop = int(self.samples[behind]) if behind < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[start // 8 : (stop + 7) // 8], bitorder="little")
        ones = np.flatnonzero(bits) + start // 8 * 8
        ones = ones[ones >= start][first - block * EVERY : last - block * EVERY]
        high = ones - np.arange(first, last)
        return (high << self.low_bits) | self._low(first, last)

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.int64)
        a, b = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a]
        return bits.reshape(-1, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def __getitem__(self, i: int) -> int:
        return int(self.select(i, i + 1)[0])

    def __len__(self) -> int:
        return self.n
