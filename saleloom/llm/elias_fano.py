"""Elias-Fano coding of non-decreasing integers, with a sampled select structure."""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256  # every SAMPLE-th one of the upper bits has its position stored
_HEAD = struct.Struct("<QQBQQ")


def _pack(values: np.ndarray, bits: int) -> bytes:
    if not bits or not len(values):
        return b""
    columns = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(columns.astype(np.uint8).ravel(), bitorder="little").tobytes()


class EliasFano:
    """``n`` values use about 2 + log2(last / n) bits each.

    The low ``bits`` of each value are stored packed. The high parts are unary gaps: value i sets bit
    ``(value >> bits) + i``. ``select`` finds the i-th set bit from the nearest stored sample.
    """

    def __init__(self, n: int, bits: int, first: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.bits, self.first, self.low, self.high, self.samples = n, bits, first, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        n = len(values)
        first = int(values[0]) if n else 0
        # Differences to the first value fit 64 unsigned bits even between the ends of the signed range.
        shifted = values.astype(np.uint64) - np.uint64(first & 0xFFFFFFFFFFFFFFFF)
        if n and (values[1:] < values[:-1]).any():
            raise ValueError("values must not decrease")
        top = int(shifted[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        ones = (shifted >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        flags[ones] = 1
        mask = np.uint64((1 << bits) - 1)
        low = np.frombuffer(_pack(shifted & mask, bits), dtype=np.uint8)
        return cls(n, bits, first, low, np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype("<u8"))

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.first & 0xFFFFFFFFFFFFFFFF, self.bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, first, bits, n_low, n_high = _HEAD.unpack_from(data)
        at = _HEAD.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        samples = np.frombuffer(data, "<u8", -(-n // SAMPLE), at + n_low + n_high)
        return cls(n, bits, first - (1 << 64) if first >> 63 else first, low, high, samples)

    def _low(self, i: int) -> int:
        start = i * self.bits
        raw = self.low[start >> 3 : (start + self.bits + 7) >> 3].tobytes()
        return (int.from_bytes(raw, "little") >> (start & 7)) & ((1 << self.bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value, from one sample interval of the upper bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start, nth = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, seen = start >> 3, 0
        skip = start & 7
        while True:
            block = np.unpackbits(self.high[byte : byte + 64], bitorder="little")
            block[:skip] = 0
            ones = np.flatnonzero(block)
            if seen + len(ones) > nth:
                at = byte * 8 + int(ones[nth - seen])
                return self.first + (((at - i) << self.bits) | self._low(i))
            seen, byte, skip = seen + len(ones), byte + 64, 0

    def decode(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n].astype(np.uint64)
        high = (ones - np.arange(self.n, dtype=np.uint64)) << np.uint64(self.bits)
        low = np.zeros(self.n, dtype=np.uint64)
        if self.bits and self.n:
            columns = np.unpackbits(self.low, bitorder="little")[: self.n * self.bits].reshape(self.n, self.bits)
            for bit in range(self.bits):
                low |= columns[:, bit].astype(np.uint64) << np.uint64(bit)
        return ((high | low) + np.uint64(self.first & 0xFFFFFFFFFFFFFFFF)).astype(np.int64)
