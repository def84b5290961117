"""Words of UTF-8 text as numpy arrays, for functions that run on Arrow batches.

A word is a maximal run of bytes other than space and 0x09-0x0D. Nothing here
makes a Python object per word: a column's bytes are split, hashed and combined
to n-grams with whole-array operations, a piece of about PIECE_BYTES at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_JOIN = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    starts: np.ndarray  # byte of each word's start
    ends: np.ndarray    # byte after each word's end
    first: np.ndarray   # index of each text's first word, and the number of words

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null is empty."""
    column = column.cast(pa.large_binary()) if column.null_count == 0 else pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data, offsets


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts."""
    if not len(column):
        return
    data, offsets = utf8(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lowered."""
    return _LOWER[data]


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of each text."""
    inside = ~_SPACE[data]
    before = np.zeros(len(data) + 1, bool)  # a text begins here
    before[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | before[1:-1]
    ends = inside
    ends[:-1] &= ~inside[1:] | before[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _weights(n: int, lane: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _JOIN + np.uint64(lane * 0x51ED2701 + 1)) | np.uint64(1)


def hash_words(data: np.ndarray, words: Words, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes; lanes are independent of each other."""
    if not len(words.starts):
        return np.zeros(0, np.uint64)
    begin = words.starts[0]
    lengths = words.ends - words.starts
    spans = np.diff(words.starts, append=len(data))
    at = np.arange(begin, len(data)) - np.repeat(words.starts, spans)
    longest = int(lengths.max())
    value = data[begin:].astype(np.uint64) + np.uint64(1)
    value[at >= np.repeat(lengths, spans)] = 0
    value *= _weights(longest + 1, lane)[np.minimum(at, longest)]
    return mix(np.add.reduceat(value, words.starts - begin) + lengths.astype(np.uint64) * _JOIN)


def join_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a's sequence followed by b's."""
    return mix(a * _JOIN + b)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive items, at the first one's index."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out, width, power, size = None, 0, hashes, 1
    while True:
        if n & size:
            if out is None:
                out, width = power, size
            else:
                keep = len(hashes) - width - size + 1
                out, width = join_hashes(out[:keep], power[width:width + keep]), width + size
        size *= 2
        if size > n:
            return out
        power = join_hashes(power[:-(size // 2)], power[size // 2:])


def inside_texts(first: np.ndarray, n: int) -> np.ndarray:
    """True for each start of n consecutive items that lie in one text."""
    total = int(first[-1])
    ok = np.zeros(max(0, total - n + 1), bool)
    counts = np.diff(first)
    # Each text of c items has c - n + 1 starts from its first item on.
    step = np.zeros(total + 1, np.int64)
    long = counts >= n
    np.add.at(step, first[:-1][long], 1)
    np.add.at(step, first[:-1][long] + counts[long] - n + 1, -1)
    ok[:] = np.cumsum(step)[:len(ok)] > 0
    return ok


def sliding(values: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each n consecutive values."""
    size, out = 1, values
    while size * 2 <= n:
        out = pick(out[:-size], out[size:])
        size *= 2
    return out if size == n else pick(out[:len(values) - n + 1], out[n - size:n - size + len(values) - n + 1])
