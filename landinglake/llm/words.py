"""Words of an Arrow batch as 64-bit hashes, computed over the raw UTF-8 buffer with numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D, so words never need decoding. The hash of
a word is a polynomial over one random 64-bit value per byte, modulo 2**64, then mixed; windows
of words are hashed the same way over the word hashes. Equal words or windows always agree;
different ones agree with a chance of about 2**-64 per pair, which all users of this module accept.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

# Bytes hashed in one step; bounds the temporary arrays to a few dozen MB.
STEP_BYTES = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Breaks for words without punctuation: all of ASCII but letters and digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BASE = 0x9E3779B97F4A7C15
_WINDOW_BASE = 0xD6E8FEB86659FD93
_random = np.random.Generator(np.random.PCG64(20240229))
_PLAIN = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _PLAIN.copy()
_LOWER[ord("A"):ord("Z") + 1] = _PLAIN[ord("a"):ord("z") + 1]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit result."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


@lru_cache(maxsize=8)
def _powers(base: int, length: int) -> np.ndarray:
    values = np.full(length, base, np.uint64)
    values[0] = 1
    return np.multiply.accumulate(values)


def powers(base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least ``length`` of each."""
    size = 1 << max(10, int(length).bit_length())
    return _powers(base, size), _powers(pow(base, -1, 2**64), size)


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows in them; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = (np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
            if buffers[2] is not None else np.zeros(0, np.uint8))
    return data, offsets - offsets[0]


class Words:
    """All words of a batch: ``hashes``, byte ``starts`` and ``ends``, and ``first``, the
    offsets of the rows in them. ``breaks`` marks the bytes between words."""

    def __init__(self, column: pa.Array, lower: bool, breaks: np.ndarray = SPACE):
        self.data, self.offsets = utf8_buffer(column)
        self.starts, self.ends = _spans(self.data, self.offsets, breaks)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.hashes = _word_hashes(self.data, self.starts, self.ends, _LOWER if lower else _PLAIN)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, word: int) -> bytes:
        return self.data[self.starts[word]:self.ends[word]].tobytes()

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words within one row, and each one's first word."""
        total = len(self.hashes)
        if total < size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        rows_end = np.repeat(self.first[1:], self.counts())
        at = np.flatnonzero(np.arange(total) + size <= rows_end)
        return window_hashes(self.hashes, size)[at], at


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2**64, of all windows of ``size`` consecutive values."""
    up, down = powers(_WINDOW_BASE, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[:len(hashes) - size + 1])


def _spans(data: np.ndarray, offsets: np.ndarray,
           breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after its last one; rows end words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~breaks[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    opens[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def _word_hashes(data, starts, ends, table) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    word = 0
    while word < len(starts):
        base = starts[word]
        last = max(word + 1, int(np.searchsorted(ends, base + STEP_BYTES)))
        values = table[data[base:ends[last - 1]]]
        up, down = powers(_BASE, len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=sums[1:])
        begin, end = starts[word:last] - base, ends[word:last] - base
        out[word:last] = mix((sums[end] - sums[begin]) * down[begin])
        word = last
    return out


def sorted_within(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A copy with each row's slice sorted."""
    values = values.copy()
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - begin > 1:
            values[begin:end].sort()
    return values


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of ``size`` words of each row, sorted, and the offsets of the rows.

    A row with fewer words has one value for its whole sequence; one without words has none.
    """
    counts = words.counts()
    sizes = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(sizes)])
    values = np.empty(first[-1], np.uint64)
    hashes, at = words.windows(size)
    row = np.searchsorted(words.first, at, side="right") - 1
    values[first[row] + at - words.first[row]] = hashes
    for short in np.flatnonzero((counts > 0) & (counts < size)).tolist():
        part = words.hashes[words.first[short]:words.first[short + 1]]
        values[first[short]] = mix(window_hashes(part, len(part)) + np.uint64(len(part)))[0]
    values = sorted_within(values, first)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[first[:-1][sizes > 0]] = True
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], kept_before[first]


def set_fingerprints(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit value per row that depends on its set of values alone; 0 for an empty set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(_BASE)),
                                                             dtype=np.uint64)])
    found = mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))
    return np.where(np.diff(first) > 0, found | np.uint64(1), np.uint64(0))
