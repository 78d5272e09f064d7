"""Elias-Fano coding of nondecreasing sequences, with a select structure."""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 64  # ones between two sampled positions of the upper bits
HEAD = struct.Struct("<QQB7xQQQ")  # n, universe, low bits, bytes of: low part, upper part, samples


def encode(values: np.ndarray) -> bytes:
    """Values (nondecreasing, not negative) in about 2 + log2(universe / n) bits each.

    The low bits are packed as they are; the rest is a unary code with one set bit per value.
    Every ``SAMPLE``-th set bit's position is kept, as 32 bits relative to the value's index
    where that suffices, so that select reads a bounded piece of the upper bits.
    """
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    universe = int(values[-1]) if n else 0
    low = max(0, (universe // max(n, 1)).bit_length() - 1)
    lows = values & np.uint64((1 << low) - 1)
    bits = ((lows[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    packed = np.packbits(bits.ravel(), bitorder="little").tobytes()
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n, dtype=np.int64)
    upper = np.zeros((int(ones[-1]) if n else 0) // 8 + 1, dtype=np.uint8)
    np.bitwise_or.at(upper, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
    samples = ones[::SAMPLE].astype("<u8" if n and ones[-1] >= 1 << 32 else "<u4")
    body = packed + upper.tobytes() + samples.tobytes()
    return HEAD.pack(n, universe, low, len(packed), len(upper), samples.nbytes) + body


class EliasFano:
    """Reads an encoded sequence: ``select(i)`` for one value, ``values()`` for all."""

    def __init__(self, data: bytes):
        self.n, self.universe, self.low, a, b, c = HEAD.unpack_from(data)
        at = HEAD.size
        self.packed = np.frombuffer(data, np.uint8, a, at)
        self.upper = np.frombuffer(data, np.uint8, b, at + a)
        width = "<u8" if self.n and c == 8 * -(-self.n // SAMPLE) else "<u4"
        self.samples = np.frombuffer(data, np.dtype(width), c // np.dtype(width).itemsize, at + a + b)
        self.bytes = HEAD.size + a + b + c

    def select(self, i: int) -> int:
        """The i-th value: from the nearest sample, the set bits are counted forward."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start, skip = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, chunk, seen, base = start >> 3, 64, 0, start & 7
        while True:
            bits = np.unpackbits(self.upper[byte : byte + chunk], bitorder="little")
            bits[:base] = 0
            found = np.flatnonzero(bits)
            if seen + len(found) > skip:
                one = 8 * byte + int(found[skip - seen])
                break
            seen, byte, base = seen + len(found), byte + chunk, 0
        high = one - i
        first = i * self.low
        piece = np.unpackbits(self.packed[first >> 3 : (first + self.low + 7) >> 3], bitorder="little")
        lows = piece[first & 7 : (first & 7) + self.low]
        return (high << self.low) | sum(int(b) << k for k, b in enumerate(lows))

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64)
        bits = np.unpackbits(self.packed, bitorder="little")[: self.n * self.low]
        lows = bits.reshape(self.n, self.low).astype(np.uint64) << np.arange(self.low, dtype=np.uint64)
        return (high << np.uint64(self.low)) | lows.sum(axis=1, dtype=np.uint64)
