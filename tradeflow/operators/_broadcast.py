"""Broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension (rows) that is shipped whole to every task. The published
# dimensions have at most a few hundred rows; anything larger joins by shuffle.
MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(dim: DataFrame, known_rows: int | None = None,
                      max_rows: int = MAX_BROADCAST_ROWS, check: bool = False) -> DataFrame:
    """``broadcast(dim)`` only when it provably holds at most ``max_rows`` rows.

    ``known_rows`` is a bound the caller already has (a dimension built from a
    Python list, a partition count). With ``check=True`` the bound is measured
    by a ``limit(max_rows + 1)`` count (one small job that stops early).
    Otherwise no hint is added: Spark still broadcasts the side when its
    statistics are under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
    switches a planned shuffle join to a broadcast from the side's runtime
    size. Both are size checks, and beyond them the join shuffles.
    """
    if known_rows is None and check:
        known_rows = dim.limit(max_rows + 1).count()
    if known_rows is not None and known_rows <= max_rows:
        return F.broadcast(dim)
    return dim
