"""Maximal runs of characters in a column of texts, for functions on Arrow batches.

A text of any length is read in blocks of bounded size: blocks end between
texts or, inside a long one, at a byte that no run can hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tradeflow.llm.words import lower_ascii, utf8

#: Bytes of text read at once.
BLOCK_BYTES = 4 << 20


class Counted(NamedTuple):
    """How often each text holds each distinct run: one entry per pair."""
    row: np.ndarray       # of the batch
    term: np.ndarray      # index into terms
    count: np.ndarray
    terms: pa.LargeBinaryArray


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; none crosses a text's end."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.zeros(len(inside) + 1, bool)
    begins[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | begins[1:-1]
    ends[:-1] &= ~inside[1:] | begins[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def blocks(column: pa.Array, outside: np.ndarray, size: int = BLOCK_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """(first row, row after the last, bytes, offsets, more of this text follows).

    ``outside`` tells the 256 byte values that are in no run: a text longer
    than ``size`` is cut after such a byte and comes as several blocks of one
    row. Only a single run longer than ``size`` makes a block longer than it.
    """
    if not len(column):
        return
    data, offsets = utf8(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        at, end = int(offsets[lo]), int(offsets[hi])
        while end - at > size:  # a single text
            cuts = np.flatnonzero(outside[data[at:at + size]])
            ahead = at + size
            while not len(cuts) and ahead < end:
                cuts = np.flatnonzero(outside[data[ahead:min(end, ahead + size)]]) + (ahead - at)
                cuts, ahead = cuts[:1], ahead + size
            if not len(cuts):
                break
            cut = at + int(cuts[-1]) + 1
            if cut < end:
                yield lo, hi, data[at:cut], np.array([0, cut - at]), True
            at = cut
        yield lo, hi, data[at:end], (offsets[lo:hi + 1] - at).clip(0), False
        lo = hi


def distinct_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """The runs' bytes as a dictionary array."""
    lengths = ends - starts
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [
        None, pa.py_buffer(offsets), pa.py_buffer(data[at])])
    return pc.dictionary_encode(runs)


def sum_pairs(a: np.ndarray, b: np.ndarray, n_b: int, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs of indices (b below ``n_b``) with their values summed."""
    key = a.astype(np.int64) * max(1, n_b) + b
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = np.flatnonzero(np.diff(key, prepend=-1))
    return key[cuts] // max(1, n_b), key[cuts] % max(1, n_b), *(
        np.add.reduceat(v[order], cuts) if len(cuts) else v[:0] for v in values)


def counted_runs(column: pa.Array, outside: np.ndarray,
                 find: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
                 size: int = BLOCK_BYTES) -> Iterator[Counted]:
    """The distinct runs of each text and how often it holds them, A-Z lowered.

    ``find`` gives starts and ends of the runs in (bytes, offsets). All counts
    of a text come in one item, also if it was read in several blocks.
    """
    held: list[Counted] = []
    for lo, hi, data, offsets, more in blocks(column, outside, size):
        data = lower_ascii(data)
        starts, ends = find(data, offsets)
        runs = distinct_runs(data, starts, ends)
        row = np.searchsorted(offsets[1:], starts, "right")
        term = runs.indices.to_numpy(zero_copy_only=False)
        row, term, count = sum_pairs(row, term, len(runs.dictionary), np.ones(len(starts), np.int64))
        found = Counted(row + lo, term, count, runs.dictionary)
        if more or held:
            held.append(found)
            if more:
                continue
            found, held = _merged(held), []
        yield found


def _merged(parts: list[Counted]) -> Counted:
    """The parts of one text as one."""
    every = pc.dictionary_encode(pa.concat_arrays([p.terms for p in parts]))
    index, base = every.indices.to_numpy(zero_copy_only=False), np.cumsum([0, *(len(p.terms) for p in parts)])
    term = np.concatenate([index[base[k] + p.term] for k, p in enumerate(parts)])
    row, term, count = sum_pairs(np.concatenate([p.row for p in parts]), term, len(every.dictionary),
                                 np.concatenate([p.count for p in parts]))
    return Counted(row, term, count, every.dictionary)
