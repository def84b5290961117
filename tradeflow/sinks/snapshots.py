"""A partitioned table that readers always see whole.

Each publish writes its partitions to a folder of its own; a pointer table says
which folder holds which partition. A new pointer table becomes visible in one
step, by the creation of one numbered file, so a reader sees the state before
or after a publish, rewritten and emptied partitions alike. A snapshot that was
opened earlier keeps reading its own folders until :func:`vacuum` removes them.

Layout: ``<root>/data/v=<run>/<column>=<value>/...`` and ``<root>/pointers/<number>``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .paths import create, delete, exists, modified, names, read_text
from .tables import write_partitions

#: Last line of a pointer file: one without it is still being written.
END = "end"
#: Publishers that meet rebase their pointers; more meetings than this are an error.
MOST_TRIES = 50


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: which folder holds each partition."""
    spark: SparkSession
    root: str
    number: int
    #: Partition folder name (``year=1997``) to the data folder that holds it: one entry a partition.
    pointers: dict[str, str] = field(default_factory=dict)

    def partitions(self) -> list[str]:
        return sorted(self.pointers)

    def read(self, schema: str, values: Iterable | None = None) -> DataFrame:
        """The rows of this state, or of the given partition values only (no
        other folder is listed). ``schema`` has the partition column too."""
        wanted = None if values is None else {str(v) for v in values}
        paths = [f"{self.root}/data/{folder}/{part}" for part, folder in sorted(self.pointers.items())
                 if wanted is None or part.split("=", 1)[1] in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(f"{schema}, v string").option("basePath", f"{self.root}/data")
                .parquet(*paths).drop("v"))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted((int(n) for n in names(spark, f"{root}/pointers") if n.isdigit()), reverse=True)


def _pointers(spark: SparkSession, root: str, number: int) -> dict[str, str] | None:
    lines = read_text(spark, f"{root}/pointers/{number:012d}").split("\n")
    return dict(line.split("\t") for line in lines[:-1]) if lines[-1] == END else None


def open_snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The newest whole state; of a table never published, the empty one (number 0)."""
    root = root.rstrip("/")
    for number in _numbers(spark, root):
        found = _pointers(spark, root, number)
        if found is not None:
            return Snapshot(spark, root, number, found)
    return Snapshot(spark, root, 0)


def is_published(spark: SparkSession, root: str) -> bool:
    return open_snapshot(spark, root).number > 0


def publish(spark: SparkSession, df: DataFrame, root: str, emptied: Iterable = (), column: str = "year",
            sort_within: Sequence[str] = (), numeric: Sequence[str] = (), whole: bool = False) -> Snapshot:
    """Replace the partitions that ``df`` holds and drop the ``emptied`` ones, in
    one step; with ``whole`` every other partition goes too.

    ``df`` is read more than once (ranges are sampled) and should be a written
    table. A publish that fails before its last step leaves the table as it was.
    Two publishers at a time both succeed; of a partition that both wrote the
    later one stays.
    """
    root, run = root.rstrip("/"), f"v={time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
    write_partitions(df, f"{root}/data/{run}", [column], sort_within, numeric, replace_all=True)
    written = {part: run for part in names(spark, f"{root}/data/{run}") if part.startswith(f"{column}=")}
    gone = {f"{column}={value}" for value in emptied}
    for _ in range(MOST_TRIES):
        old = open_snapshot(spark, root)
        kept = {} if whole else {part: folder for part, folder in old.pointers.items() if part not in gone}
        pointers = kept | written
        # A number taken by an unfinished file is passed over, not written again.
        number = max([old.number, *_numbers(spark, root)[:1]]) + 1
        text = "\n".join([f"{part}\t{folder}" for part, folder in sorted(pointers.items())] + [END])
        if create(spark, f"{root}/pointers/{number:012d}", text):
            return Snapshot(spark, root, number, pointers)
    raise RuntimeError(f"{root}: {MOST_TRIES} other publishers came first")


def vacuum(spark: SparkSession, root: str, keep: int = 2, age_seconds: float = 86_400) -> list[str]:
    """Remove partition folders that none of the newest ``keep`` states point to
    and that are older than ``age_seconds`` (a running publish has written, but
    not yet pointed to, younger ones), and the pointer files of older states.
    Returns what was removed."""
    root = root.rstrip("/")
    numbers = [n for n in _numbers(spark, root) if _pointers(spark, root, n) is not None]
    used = {f"{folder}/{part}" for n in numbers[:max(1, keep)] for part, folder in _pointers(spark, root, n).items()}
    removed = []
    for folder in names(spark, f"{root}/data"):
        parts = [p for p in names(spark, f"{root}/data/{folder}") if "=" in p]
        if time.time() - modified(spark, f"{root}/data/{folder}") < age_seconds:
            continue
        free = [p for p in parts if f"{folder}/{p}" not in used]
        if len(free) == len(parts):
            delete(spark, f"{root}/data/{folder}")
        else:
            for part in free:
                delete(spark, f"{root}/data/{folder}/{part}")
        removed += [f"{folder}/{p}" for p in free]
    for number in numbers[max(1, keep):]:
        if exists(spark, f"{root}/pointers/{number:012d}"):
            delete(spark, f"{root}/pointers/{number:012d}")
    return sorted(removed)
