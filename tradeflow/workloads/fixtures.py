"""Source-shaped inputs derived from the star tables, written once per session.

Spreadsheet cells, API response documents and raw source rows stand for files
in a landing folder. Each is built by Spark from the test tables and written
to the checkpoint folder (``checkpoint()``) the first time a query needs it;
later queries of the same session read that table, as they would read the
landing folder.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

_DONE: dict[tuple[int, str, str], DataFrame] = {}
_LANDED: dict[tuple[int, str, str], tuple[SparkSession, str]] = {}
# Seconds that the builds took since the last forget(), by name.
BUILT: dict[str, float] = {}


def forget() -> None:
    """Let the next query build its inputs anew (the bench times that too)."""
    _DONE.clear()
    _LANDED.clear()
    BUILT.clear()


def materialized(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (id(spark), sf.rstrip("/"), name)
    df = _DONE.get(key)
    if df is None or df.sparkSession is not spark:
        began = time.perf_counter()
        df = build().checkpoint()
        BUILT[name] = BUILT.get(name, 0.0) + time.perf_counter() - began
        _DONE[key] = df
    return df


def landed(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    """A folder of files that ``write(folder)`` has written, once per session."""
    key = (id(spark), sf.rstrip("/"), name)
    owner, folder = _LANDED.get(key, (None, ""))
    if owner is not spark:
        folder = f"{checkpoint_dir(spark).rstrip('/')}/landing/{name}-{uuid.uuid4().hex}"
        began = time.perf_counter()
        write(folder)
        BUILT[name] = BUILT.get(name, 0.0) + time.perf_counter() - began
        _LANDED[key] = spark, folder
    return folder
