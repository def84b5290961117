"""Count-min sketches merged over partitions, kept to "seen more than once".

A sketch has two rows of ``cells`` counters. Each task adds what it has seen to
a sketch of its own, written sparsely as blocks of BLOCK cells; blocks merge by
addition, counters stop at two. The merged estimate of a key is never below
its true count (up to two), so a key that occurs twice is always found; a key
that occurs once is taken for repeated where both of its cells are shared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tradeflow.llm.common import lean

BLOCK = 1 << 16
#: Bounds of the cells of one sketch row. The merged sketch, one bit a cell, is
#: sent to every executor: 32 MB at most.
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 27
#: Keys a task holds before it writes them out as one sketch.
FLUSH = 1 << 22


def cells_for(keys: float) -> int:
    """A power of two of about 16 cells a key, within the bounds."""
    wanted = 1 << max(0, int(np.ceil(np.log2(max(1.0, 16 * keys)))))
    return min(MOST_CELLS, max(LEAST_CELLS, wanted))


def cells_of(keys: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each 64-bit key in both rows."""
    mask = np.uint64(cells - 1)
    return [keys & mask, (keys >> np.uint64(32)) & mask]


def repeated_cells(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
                   cells: int) -> DataFrame:
    """Merged sketch of the keys that ``keys_of`` takes from the batches of
    ``df``: rows (row, block, bits), bits set for cells that count two or more."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                if sum(map(len, held)) >= FLUSH:
                    yield from blocks(np.concatenate(held))
                    held = []
        if held:
            yield from blocks(np.concatenate(held))

    def blocks(keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        for row, at in enumerate(cells_of(keys, cells)):
            at, n = np.unique(at, return_counts=True)
            block = (at // BLOCK).astype(np.int64)
            offset = (at % BLOCK).astype(np.uint16)
            cuts = np.flatnonzero(np.diff(block, prepend=-1))
            out: dict[str, list] = {"block": [], "once": [], "more": []}
            for lo, hi in zip(cuts, [*cuts[1:], len(at)]):
                out["block"].append(row * (cells // BLOCK) + int(block[lo]))
                out["once"].append(offset[lo:hi][n[lo:hi] == 1].tobytes())
                out["more"].append(offset[lo:hi][n[lo:hi] > 1].tobytes())
            yield pa.RecordBatch.from_pydict(out, pa.schema(
                [("block", pa.int64()), ("once", pa.binary()), ("more", pa.binary())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by block: one block is held at a time.
        now, count = None, None
        for batch in batches:
            for block, once, more in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if block != now:
                    if now is not None:
                        yield merged(now, count)
                    now, count = block, np.zeros(BLOCK, np.uint8)
                count[np.frombuffer(more, np.uint16)] = 2
                at = np.frombuffer(once, np.uint16)
                count[at] = np.minimum(count[at] + 1, 2)
        if now is not None:
            yield merged(now, count)

    def merged(block: int, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()),
                                           "bits": pa.array([np.packbits(count > 1).tobytes()], pa.binary())})

    return (df.mapInArrow(lean(sketch), "block long, once binary, more binary")
            .repartition("block").sortWithinPartitions("block")
            .mapInArrow(lean(merge), "block long, bits binary"))


def share(sketch: DataFrame) -> Broadcast:
    """The merged sketch (of bounded size) on every executor, for ``Repeated``."""
    return sketch.sparkSession.sparkContext.broadcast([(r["block"], r["bits"]) for r in sketch.collect()])


class Repeated:
    """Looks keys up in a collected sketch; unpickled once per task."""

    def __init__(self, rows: list, cells: int):
        self.cells = cells
        self.bits = np.zeros(2 * cells // 8, np.uint8)
        for block, bits in rows:
            self.bits[block * (BLOCK // 8):(block + 1) * (BLOCK // 8)] = np.frombuffer(bits, np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """True where the estimated count is two or more."""
        found = np.ones(len(keys), bool)
        for row, at in enumerate(cells_of(keys, self.cells)):
            at = at.astype(np.int64) + row * self.cells
            found &= (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return found


def split_by_members(df: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``column`` (a 64-bit number) may be among the one
    column of ``keys``, all that are and few others, and the rows that cannot
    be. Spares a join the rows that it would not match; it does not replace the
    join. ``keys`` is read twice and should be a written table."""
    cells = cells_for(keys.count())

    def twice(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield np.repeat(batch.column(0).to_numpy().view(np.uint64), 2)

    sketch = share(repeated_cells(keys, twice, cells))

    def keep(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Repeated(sketch.value, cells)
            for batch in batches:
                at = np.flatnonzero(known(batch.column(column).to_numpy().view(np.uint64)) == wanted)
                yield batch.take(pa.array(at, pa.int64()))
        return df.mapInArrow(lean(run), df.schema)

    return keep(True), keep(False)
