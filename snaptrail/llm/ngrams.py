"""Hashed n-grams of bytes, as arrays; small helpers of the classifiers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

# Maps A-Z to a-z and every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MIX = np.uint64(0x9E3779B97F4A7C15)


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text, without copying; null is empty."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    for chunk in chunks:
        chunk = chunk.cast(pa.large_binary())
        _, offsets, data = chunk.buffers()
        ends = np.frombuffer(offsets, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        valid = chunk.is_valid().to_numpy(zero_copy_only=False)
        for start, end, known in zip(ends[:-1], ends[1:], valid):
            yield data[start:end] if known else data[:0]


def ngram_buckets(text: np.ndarray, sizes: Sequence[int], bits: int) -> np.ndarray:
    """The bucket, below 2**bits, of each n-gram of each size (up to 8 bytes), A-Z lower-cased.

    A space is put on both ends, so that a short text has n-grams and words at its ends count as words.
    """
    padded = np.full(len(text) + 2, 32, dtype=np.uint64)
    padded[1:-1] = LOWER[text]
    key, found = padded, []
    for n in range(1, max(sizes) + 1):
        if n > 1:
            key = (key[:-1] << np.uint64(8)) | padded[n - 1 :]
        if n in sizes and len(key):
            mixed = (key ^ (key >> np.uint64(23))) * _MIX
            found.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def letters(text: np.ndarray) -> np.ndarray:
    """The text with each run of ASCII bytes that are no letters as one space."""
    plain = _LETTERS[text]
    blank = plain == 32
    return plain[~(blank & np.concatenate([[False], blank[:-1]]))]


_LETTERS = LOWER.copy()
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 32
