"""Helpers shared by the corpus operators: scratch tables and split joins."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.session import checkpoint_dir

#: A key with at least 1/HEAVY_PARTS of all rows is resolved without a shuffle,
#: so at most HEAVY_PARTS such keys exist: the bound of what is broadcast.
HEAVY_PARTS = 1024


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of these files, not the
    work before them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing will read any more."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(conf).delete(path, True)


def give_back() -> None:
    """Return to the system what this Python worker has freed.

    Allocators keep freed memory for their next use, but a worker outlives its
    task: what one stage's largest batch took would stay beside the executor's
    heap through all later stages.
    """
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # glibc has it, other systems need not
        ctypes.CDLL(None).malloc_trim(0)


def lean(task: Callable) -> Callable:
    """A function for ``mapInArrow`` whose worker keeps no freed memory after it."""
    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()
    return run


def text_or_empty(name: str = "text") -> Column:
    """The text column, null as the empty string."""
    return F.coalesce(F.col(name), F.lit(""))


def join_counted(rows: DataFrame, groups: DataFrame, on: list[str], count: str,
                 total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to one-row-per-key ``groups``, hot keys without a shuffle.

    ``count`` is the column of ``groups`` that holds the exact number of
    ``rows`` with that key and ``total`` the number of rows. Keys that hold at
    least ``total / HEAVY_PARTS`` rows (at most HEAVY_PARTS of them, however
    large the tables) are broadcast and joined where the rows lie; the others,
    none of them large, take an ordinary shuffled join. No row is lost: the
    two parts are complements. ``groups`` is read twice and should be a
    written table. ``how`` is ``inner`` or ``left``; keys are not null.
    """
    least = max(2.0, total / HEAVY_PARTS)
    hot = groups.filter(F.col(count) >= least)
    cold = groups.filter(F.col(count) < least)
    by_broadcast = rows.join(F.broadcast(hot), on, "inner")
    others = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return by_broadcast.unionByName(others.join(cold, on, how), allowMissingColumns=how == "left")
