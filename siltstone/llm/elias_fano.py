"""Elias-Fano sequences: monotone integers in about 2 + log2(universe / n) bits each.

A value is split into high and low bits. Low bits lie packed side by side; high bits are written in
unary, so that the i-th one bit stands at (high of value i) + i. All reads below work on whole arrays of
queries and on buffers that may be memory-mapped.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64


class EliasFano:
    """A sorted sequence of unsigned integers below 2^64, over a buffer made by `encode`."""

    def __init__(self, buffer: np.ndarray):
        head = buffer[:24].view(_U)
        self.n, self.low_bits, size = int(head[0]), int(head[1]), int(head[2])
        low = np.ascontiguousarray(buffer[24 : 24 + size])
        # Eight bytes from any byte on, as one number.
        self._window = np.ndarray(shape=(size - 7,), dtype="<u8", buffer=low, strides=(1,))
        ones = np.flatnonzero(np.unpackbits(buffer[24 + size :], bitorder="little"))[: self.n]
        self._high = (ones - np.arange(self.n)).astype(_U)
        self.nbytes = len(buffer)

    @staticmethod
    def encode(values: np.ndarray) -> np.ndarray:
        values = values.astype(_U)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = min(56, max(0, (top // max(1, n)).bit_length() - 1))
        # Fewer low bits than 56 are always enough unless values are few and huge; high bits then grow.
        while n and (top >> low_bits) > 64 * n + 64 and low_bits < 56:
            low_bits += 1
        total = n * low_bits
        low = np.zeros((total + 7) // 8 + 8, dtype=np.uint8)
        for first in range(0, n, 1 << 16):
            part = values[first : first + (1 << 16)]
            bits = ((part[:, None] >> np.arange(low_bits, dtype=_U)) & _U(1)).astype(np.uint8).ravel()
            packed = np.packbits(bits, bitorder="little")  # 2^16 values end on a byte
            at = first * low_bits // 8
            low[at : at + len(packed)] = packed
        high = values >> _U(low_bits)
        unary = np.zeros((int(high[-1]) if n else 0) + n + 1, dtype=np.uint8)
        unary[(high + np.arange(n, dtype=_U)).astype(np.int64)] = 1
        head = np.array([n, low_bits, len(low)], dtype=_U).view(np.uint8)
        return np.concatenate([head, low, np.packbits(unary, bitorder="little")])

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at the places `i`."""
        i = np.asarray(i, dtype=np.int64)
        if self.low_bits == 0:
            return self._high[i]
        at = i * self.low_bits
        low = (self._window[at >> 3] >> (at & 7).astype(_U)) & ((_U(1) << _U(self.low_bits)) - _U(1))
        return (self._high[i] << _U(self.low_bits)) | low

    def successor(self, x: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | int | None = None) -> np.ndarray:
        """For each query the first place in [first, last) whose value is at least x (`last` if none)."""
        x = np.asarray(x, dtype=_U)
        last = self.n if last is None else last
        # Only places whose high bits equal those of x need their low bits looked at.
        low = np.maximum(np.searchsorted(self._high, x >> _U(self.low_bits), side="left"), first)
        high = np.minimum(np.searchsorted(self._high, x >> _U(self.low_bits), side="right"), last)
        low = np.minimum(low, last)
        high = np.maximum(high, low)
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = self.access(middle) < x[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < high[open_]]
        return low
