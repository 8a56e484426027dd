"""Words of many texts at once: a column of an Arrow batch as flat numpy arrays.

A text is cut into runs of word bytes; every run gets a 64-bit hash. Texts are taken
in chunks of about ``CHUNK`` bytes (a longer text is a chunk of its own), so memory
follows the longest text, never the batch. Null counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
#: Separators of the two kinds of words the contracts name.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
_ALNUM = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}

_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 2**63, 2, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WINDOW = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_bytes(blank: bool) -> np.ndarray:
    """Which bytes belong to words: all but blanks, or letters and digits only."""
    return np.array([(b not in BLANKS) if blank else (b in _ALNUM) for b in range(256)])


_BLANK_TABLE, _ALNUM_TABLE = word_bytes(True), word_bytes(False)
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


@dataclass
class Words:
    """Words of the texts ``first`` to ``first + len(offsets) - 2`` of a batch."""

    first: int
    data: np.ndarray  # bytes of the texts, one after the other
    offsets: np.ndarray  # of the texts in data, one more than texts
    start: np.ndarray  # of the words in data
    end: np.ndarray
    doc: np.ndarray  # text of each word, counted from first
    hash: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    def bounds(self) -> np.ndarray:
        """Index of the first word of each text, and the number of words."""
        return np.searchsorted(self.doc, np.arange(self.texts + 1))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word, and hash, of all windows of n words in one text."""
        if len(self.doc) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        m = len(self.doc) - n + 1
        at = np.flatnonzero(self.doc[:m] == self.doc[n - 1 :])
        total = np.zeros(m, np.uint64)
        for j in range(n):
            total += self.hash[j : j + m] * _WINDOW[j]
        return at, mix(total[at])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of the first text, bytes and offsets, for runs of about ``size`` bytes."""
    data, offsets = flat(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        own = offsets[first : last + 1]
        yield first, data[own[0] : own[-1]], own - own[0]
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, cut where a text ends."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets[offsets <= len(inside)]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each run; runs are in order, not empty and do not overlap.

    Every eight bytes are mixed with their place before they are added up: no polynomial, for which
    texts of a regular build would collide whatever its numbers are.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    blocks = (size + 7) // 8
    first = np.cumsum(blocks) - blocks
    number = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    padded = np.append(data, np.zeros(8, np.uint8))
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    value = eights[np.repeat(start, blocks) + 8 * number]
    missing = 8 * (8 - np.minimum(8, np.repeat(size, blocks) - 8 * number)).astype(np.uint64)
    value &= np.uint64(2**64 - 1) >> missing
    keyed = mix(mix(value + _BYTE[0]) + (number + 1).astype(np.uint64) * _STEP)
    return mix(np.add.reduceat(keyed, first) + mix(size.astype(np.uint64) * _BYTE[1]))


def scan(column: pa.Array, blank: bool = True, size: int = CHUNK) -> Iterator[Words]:
    """Words of a column: runs of non-blanks, unchanged, or runs of letters and digits in lower case."""
    for first, data, offsets in chunks(column, size):
        if not blank:
            data = _LOWER[data]
        start, end = runs((_BLANK_TABLE if blank else _ALNUM_TABLE)[data], offsets)
        doc = np.searchsorted(offsets, start, "right") - 1
        yield Words(first, data, offsets, start, end, doc, run_hashes(data, start, end))
