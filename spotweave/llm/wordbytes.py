"""Word and shingle fingerprints of whole texts, computed on the bytes of Arrow batches.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased.
Its fingerprint is a polynomial over a random byte table modulo 2**64, so the
fingerprints of all words of a slice come from one prefix sum; a shingle's is a
mix of the fingerprints of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # bytes hashed at once; a longer text makes a slice of its own
HASHED = 1 << 20  # bytes whose powers are held; a longer word takes as many as it has

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, dtype=bool)  # white space ends words
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])  # so do all ASCII marks
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of an odd number modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.values = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            step = np.uint64(pow(self.base, len(self.values), 2**64))
            self.values = np.concatenate([self.values, self.values * step])
        return self.values[:n]


_up, _down = _Powers(_BASE), _Powers(_INVERSE)


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string array into slices of rows: (first row, bytes, row ends); null counts as empty."""
    texts = texts.cast(pa.large_binary())
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    row = 0
    while row < len(texts):
        done = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + size, side="right")))
        joined = b"".join(x or b"" for x in texts.slice(row, stop - row).to_pylist())
        yield row, np.frombuffer(joined, dtype=np.uint8), ends[row:stop] - done
        row = stop


def bounds(data: np.ndarray, ends: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Where all words of a slice begin and end; ``breaks`` says for each byte whether it ends words."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    inside = ~breaks[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = np.unique(ends[(ends > 0) & (ends < n)])  # a word also ends where its row ends
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, step: int = HASHED) -> np.ndarray:
    """Fingerprints of the byte runs from ``begin`` to ``end``, in order; ``step`` bytes are hashed at once."""
    out = np.zeros(len(begin), dtype=np.uint64)
    i = 0
    while i < len(begin):
        base = begin[i]
        j = max(i + 1, int(np.searchsorted(end, base + step, side="right")))
        part = data[base : end[j - 1]]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * _up.upto(len(part)), out=sums[1:])
        first, last = begin[i:j] - base, end[i:j] - base
        out[i:j] = (sums[last] - sums[first]) * _down.upto(len(part))[first] + (last - first).astype(np.uint64) * _PLACE[63]
        i = j
    return mix(out)


def words(data: np.ndarray, ends: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of a slice, and for each row the index where its words end."""
    begin, end = bounds(data, ends, breaks)
    return hashes(data, begin, end), np.searchsorted(begin, ends)


def sequences(hashed: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of all runs of ``size`` words, whatever lies between them."""
    grams = np.zeros(max(0, len(hashed) - size + 1), dtype=np.uint64)
    for k in range(size if len(grams) else 0):
        grams += hashed[k : k + len(grams)] * _PLACE[k]
    return mix(grams)


def shingles_of(data: np.ndarray, ends: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text of a slice.

    A text with fewer than ``size`` words gives its whole sequence as one
    shingle; one without words gives none.
    """
    empty = np.zeros(0, dtype=np.uint64)
    hashed, stops = words(data, ends)
    grams = sequences(hashed, size)
    start = 0
    for stop in stops:
        if stop - start >= size:
            yield np.unique(grams[start : stop - size + 1])
        elif stop > start:
            own = hashed[start:stop]
            total = np.sum(own * _PLACE[: len(own)], keepdims=True)
            yield mix(total + _PLACE[len(own) + 32])  # another constant for each number of words
        else:
            yield empty
        start = stop


def shingles(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The same for all texts of an array, in row order."""
    for _, data, ends in slices(texts):
        yield from shingles_of(data, ends, size)
