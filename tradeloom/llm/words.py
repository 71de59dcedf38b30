"""Words and hashes of words and of word windows, a slice of documents at a time, in numpy.

A word is a run of bytes other than space and 0x09 to 0x0D, which is what `bytes.split()` gives on
UTF-8. Window hashes are polynomial hashes over 64-bit word hashes, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def slices(batches, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Rows in slices of at most `limit` bytes of text (a longer text is a slice of its own), and the
    texts of each slice as bytes, None where NULL."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        begin, size = 0, 0
        for i, length in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
            if i > begin and size + length > limit:
                yield batch.slice(begin, i - begin), texts.slice(begin, i - begin).to_pylist()
                begin, size = i, 0
            size += length
        if len(texts) > begin:
            yield batch.slice(begin), texts.slice(begin).to_pylist()


class Slice:
    """All words of some texts in one list; document i has the words from starts[i] to starts[i + 1]."""

    def __init__(self, texts: list, lower: bool = False):
        self.words: list[bytes] = []
        self.starts = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                self.words += (text.lower() if lower else text).split()
            self.starts[i + 1] = len(self.words)
        self.lengths = np.diff(self.starts)

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))

    def window_starts(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which a window of `width` words of one document starts, and its document."""
        counts = np.maximum(self.lengths - width + 1, 0)
        document = np.repeat(np.arange(len(counts)), counts)
        before = np.cumsum(counts) - counts
        return np.arange(counts.sum()) - before[document] + self.starts[document], document


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(_BASE, exponent, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of the `width` values from each position on, where there are so many.

    Windows of length a + b are put together from windows of lengths a and b, so that the work grows
    with the logarithm of the width.
    """
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total, done, block, size = None, 0, hashes, 1
    while True:
        if width & size:
            if total is None:
                total = block
            else:
                n = len(hashes) - done - size + 1
                total = total[:n] * _power(size) + block[done : done + n]
            done += size
        if done == width:
            return mixed(total[:count])
        block = block[: len(block) - size] * _power(size) + block[size:]
        size *= 2


def column_of(hashes: np.ndarray, columns: int) -> np.ndarray:
    """Which of `columns` equal ranges of the upper 32 bits a hash falls in; ascending with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(columns) >> np.uint64(32)).astype(np.int64)
