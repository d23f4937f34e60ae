"""Word shingles of a batch of texts as 64-bit hashes, in vectorised numpy.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z in lower case. A word hash is a polynomial of
byte values, a shingle hash one of its word hashes, both finished by a 64-bit mixer. A text with fewer words than a
shingle has one shingle, the whole sequence; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _MULTIPLIER)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


_POWER = _powers(64)


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts with a space before each, and the position of each text's space."""
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    return np.insert(data, starts, 0x20), starts + np.arange(len(starts))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for n texts the n + 1 bounds of each text's words. Null texts must be filled."""
    data, starts = _text_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    blank = _BLANK[data]
    first = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    end = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    bounds = np.append(np.searchsorted(first, starts), len(first))
    if not len(first):
        return np.zeros(0, np.uint64), bounds
    size = end - first
    letters = np.flatnonzero(~blank)
    at = np.arange(len(letters)) - np.repeat(np.cumsum(size) - size, size)
    power = _POWER if size.max() <= len(_POWER) else _powers(int(size.max()))
    terms = _BYTE[data[letters]] * power[at]
    return mix(np.add.reduceat(terms, np.cumsum(size) - size) + size.astype(np.uint64)), bounds


def shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``width`` words in text order, repeats included, and the bounds of each text."""
    words, bounds = word_hashes(texts)
    count = np.diff(bounds)
    number = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    starts = np.append(0, np.cumsum(number))
    if not starts[-1]:
        return np.zeros(0, np.uint64), starts
    first = np.repeat(bounds[:-1] - starts[:-1], number) + np.arange(starts[-1])
    length = np.minimum(np.repeat(count, number), width)
    padded = np.append(words, np.zeros(width, np.uint64))
    total = length.astype(np.uint64)
    for k in range(width):
        total = mix(total * _MULTIPLIER + np.where(k < length, padded[first + k], np.uint64(0)))
    return total, starts


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    hashes, bounds = shingle_hashes(texts, width)
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
