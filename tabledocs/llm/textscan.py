"""Words, shingles and their 64-bit hashes, computed on whole Arrow batches with numpy.

Used inside tasks only. A word is a run of bytes other than space and 09-0D;
A-Z count as a-z. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: bytes of text hashed at once, which bounds the memory of a task; one longer text is one slice
SLICE_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_BYTE_VALUE = np.random.default_rng(20_26).integers(1, 2**64 - 1, 256, dtype=np.uint64, endpoint=True)[_FOLDED]
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            inverse = pow(_BASE, -1, 2**64)
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)])) for x in (_BASE, inverse)
            )
        return self.up, self.down


_POWERS = _Powers()


class Words:
    """The words of consecutive texts: document number, byte span and the means to hash any part of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        size = len(data)
        word = ~_SEPARATOR[data]
        border = np.zeros(size + 1, bool)
        border[offsets] = True
        start, end = word.copy(), word.copy()
        if size:
            start[1:] &= ~word[:-1] | border[1:size]
            end[:-1] &= ~word[1:] | border[1:size]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.document = np.searchsorted(offsets, self.start, "right") - 1
        self.documents = len(offsets) - 1
        up, self._down = _POWERS.upto(size + 1)
        self._sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * up[:size], out=self._sums[1:])

    def hashes(self, most: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first `most` bytes."""
        end = self.end if most is None else np.minimum(self.end, self.start + most)
        value = (self._sums[end] - self._sums[self.start]) * self._down[self.start]
        return mixed(value ^ (end - self.start).astype(np.uint64))

    def shingles(self, width: int) -> Iterator[tuple[np.ndarray, int]]:
        """Per document: the sorted distinct hashes of `width` consecutive words, and the number of words.

        Fewer words make one shingle of them all; no words make none.
        """
        words = self.hashes()
        counts = np.bincount(self.document, minlength=self.documents)
        first = np.concatenate([[0], np.cumsum(counts)])
        grams = words[: max(0, len(words) - width + 1)].copy()
        for k in range(1, width):
            grams = grams * _WORD_BASE + words[k : len(words) - width + 1 + k]
        grams = mixed(grams)
        for k, n in enumerate(counts):
            at = first[k]
            if n >= width:
                yield np.unique(grams[at : at + n - width + 1]), int(n)
            elif n:
                value = np.array([n], np.uint64)
                for w in words[at : at + n]:
                    value = value * _WORD_BASE + w
                yield mixed(value), int(n)
            else:
                yield words[:0], 0


def slices(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(first row, rows, words) of consecutive slices of a string column."""
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + SLICE_BYTES, "right")) - 1)
        stop = min(stop, len(texts))
        low, high = bounds[row], bounds[stop]
        yield row, stop - row, Words(data[low:high], bounds[row : stop + 1] - low)
        row = stop


def set_digests(shingles: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """128 bits of each set, as two 64-bit columns."""
    sums = [[np.add.reduce(mixed(x ^ salt)) for x in shingles] for salt in (np.uint64(0), np.uint64(0x5851F42D4C957F2D))]
    return tuple(pa.array(np.array(x, np.uint64).view(np.int64)) for x in sums)


def list_array(values: list[np.ndarray]) -> pa.Array:
    """A list column of 64-bit values."""
    lengths = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(values).view(np.int64)))
