"""A write-ahead journal of the incremental jobs.

What a run is about to touch is written down first and struck out only when
the step that makes it good has ended, so work that a failed run leaves behind
is found by the next one. An entry is a small Parquet folder of its own; it
counts once its ``_SUCCESS`` mark is there, and entries are only ever added or
removed whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import delete, exists, names

ENTRY_SCHEMA = "module string, measure string, kind string, item string, run string"
#: Kinds of entries: sources whose cache a stage run replaces, and years that a
#: stage run rebuilds and the published table must take up.
SOURCE, YEAR = "source", "year"


@dataclass(frozen=True)
class Entry:
    """One entry: who wrote it and where it lies."""
    run: str
    module: str
    measure: str
    kind: str
    path: str


class Journal:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, run: str, module: str, measure: str, kind: str, items: DataFrame) -> Entry:
        """Write down ``items`` (its first column); returns when they are durable."""
        path = f"{self.root}/entry={run}~{module}~{measure}~{kind}~{uuid.uuid4().hex[:8]}"
        first = items.columns[0]
        items.select(F.lit(module).alias("module"), F.lit(measure).alias("measure"), F.lit(kind).alias("kind"),
                     F.col(first).cast("string").alias("item"), F.lit(run).alias("run")).write.parquet(path)
        return Entry(run, module, measure, kind, path)

    def entries(self, kind: str | None = None, module: str | None = None, measure: str | None = None) -> list[Entry]:
        """Open entries, oldest run first (one driver row per run and stage, not per item)."""
        found = []
        for name in sorted(names(self.spark, self.root)):
            if not name.startswith("entry="):
                continue
            run, m, x, k, _ = name.removeprefix("entry=").split("~")
            entry = Entry(run, m, x, k, f"{self.root}/{name}")
            if kind in (None, k) and module in (None, m) and measure in (None, x) \
                    and exists(self.spark, f"{entry.path}/_SUCCESS"):
                found.append(entry)
        return found

    def read(self, entries: Iterable[Entry]) -> DataFrame:
        """The items of the entries."""
        paths = [e.path for e in entries]
        if not paths:
            return self.spark.createDataFrame([], ENTRY_SCHEMA)
        return self.spark.read.schema(ENTRY_SCHEMA).parquet(*paths)

    def years(self, entries: Iterable[Entry]) -> list[int]:
        """Distinct years of the entries."""
        return sorted(int(r.item) for r in self.read(e for e in entries if e.kind == YEAR)
                      .select("item").distinct().collect())

    def strike(self, entries: Iterable[Entry]) -> None:
        """Remove entries whose work is done."""
        for entry in entries:
            # The mark goes first: an entry half removed no longer counts, and its work is done.
            delete(self.spark, f"{entry.path}/_SUCCESS")
            delete(self.spark, entry.path)
