"""Elias-Fano code of a non-decreasing integer sequence, with select.

n values below a universe u take about 2 + log2(u / n) bits each: the low
bits of every value side by side, the high parts as unary gaps in a bit
vector. A directory keeps the position of every ``STEP``-th set bit (32 bits
each), so ``select(i)`` looks at few words and no 64-bit offset table exists.
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 256
_HEAD = struct.Struct("<QQB7x")          # n, universe, low bits


class EliasFano:
    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray,
                 directory: np.ndarray):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self.low, self.high, self.directory = low, high, directory

    @classmethod
    def of(cls, values) -> EliasFano:
        """Encode; values must be non-negative and non-decreasing."""
        v = np.asarray(values, np.uint64)
        n = len(v)
        universe = int(v[-1]) + 1 if n else 1
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        if bits:
            part = (v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(part.astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        flags[ones] = 1
        return cls(n, universe, bits, low, np.packbits(flags, bitorder="little"),
                   ones[::STEP].astype(np.uint32))

    def to_bytes(self) -> bytes:
        body = [self.low.tobytes(), self.high.tobytes(), self.directory.astype("<u4").tobytes()]
        return (_HEAD.pack(self.n, self.universe, self.low_bits)
                + struct.pack("<QQQ", *map(len, body)) + b"".join(body))

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """Decode from ``data[at:]``; also returns where the code ends."""
        n, universe, bits = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        sizes = struct.unpack_from("<QQQ", data, at)
        at += 24
        parts = []
        for size, kind in zip(sizes, (np.uint8, np.uint8, np.dtype("<u4"))):
            parts.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
            at += size
        return cls(n, universe, bits, *parts), at

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for b in range(self.low_bits):
            at = i * self.low_bits + b
            out |= ((self.low[at >> 3] >> (at & 7)) & 1).astype(np.int64) << b
        return out

    def select(self, i: int) -> int:
        """Value i: from the directory entry before it, count set bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start = int(self.directory[i // STEP])
        need = i % STEP                                   # set bits still to pass
        byte = start >> 3
        word = int(self.high[byte]) >> (start & 7) << (start & 7)
        while need >= word.bit_count():
            need -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(need):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return ((one - i) << self.low_bits) | int(self._low(np.array([i]))[0])

    def values(self) -> np.ndarray:
        """All values at once."""
        i = np.arange(self.n)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        return ((ones - i) << self.low_bits) | self._low(i)
