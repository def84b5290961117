"""Dictionary lookups as joins with small dimension tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ._broadcast import bounded_broadcast

# Unmapped values that an error message itself lists; all of them are in the
# table that it names.
MAX_LISTED = 1000


def _key_map(on) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    if isinstance(on, Mapping):
        return dict(on)
    return {c: c for c in on}


def lookup(df: DataFrame, dim: DataFrame, on, add: Sequence[str] | None = None, *,
           how: str = "left", known_rows: int | None = None) -> DataFrame:
    """Attach ``add`` columns of ``dim`` to ``df`` by key (``df_col -> dim_col``).

    A dimension is a dictionary: a key that it holds twice fails the job.
    Unmatched rows get nulls; null keys never match. Existing columns named like an added column are
    replaced, as assigning a mapped column does.
    """
    keys = _key_map(on)
    dim_keys = set(keys.values())
    add = list(add) if add is not None else [c for c in dim.columns if c not in dim_keys]
    right = dim.select(*[F.col(d).alias(s) for s, d in keys.items()], *add)
    if known_rows is None:
        right = unique_by(right, list(keys))
    left = df.drop(*[c for c in add if c in df.columns and c not in keys])
    return left.join(bounded_broadcast(right, known_rows), list(keys), how)


def lookup_default(df: DataFrame, dim: DataFrame, on, defaults: Mapping[str, object], *,
                   known_rows: int | None = None) -> DataFrame:
    """Lookup whose unmatched rows get a default per added column."""
    out = lookup(df, dim, on, list(defaults), known_rows=known_rows)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def unmapped_values(df: DataFrame, source: str, target: str) -> DataFrame:
    """Sorted distinct non-null ``source`` values whose ``target`` is null."""
    return (df.where(F.col(target).isNull() & F.col(source).isNotNull())
            .select(F.col(source).cast("string").alias(source))
            .distinct()
            .orderBy(source))


def unique_by(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dim``, failing in the plan where two rows share a non-null key."""
    others = [c for c in dim.columns if c not in keys]
    grouped = dim.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in others])
    # The check sits in the key itself, which no later plan can leave out.
    checked = F.when(F.col("__n") == 1, F.col(keys[0])).otherwise(F.raise_error(
        F.concat(F.lit("the dimension has two rows for "), F.col(keys[0]).cast("string"))))
    return grouped.withColumn(keys[0], checked).select(*dim.columns)


class UnmappedValues(ValueError):
    """Non-null sources without a target; ``table`` holds all of them (source, target, value)."""

    def __init__(self, message: str, table: str):
        super().__init__(message)
        self.table = table


def assert_mapped(df: DataFrame, source: str, target: str, context: str) -> None:
    """Fail listing every unmapped value (``context: source -> target: a, b``)."""
    assert_all_mapped(df, [(source, target)], context)


def _failed(checks: Sequence[tuple[str, str]]) -> Column:
    """Per row the (source, target, value) of each check that fails, else null."""
    return F.array(*[F.when(F.col(t).isNull() & F.col(s).isNotNull(), F.struct(
        F.lit(s).alias("source"), F.lit(t).alias("target"), F.col(s).cast("string").alias("value"))) for s, t in checks])


def assert_all_mapped(df: DataFrame, checks: Sequence[tuple[str, str]], context: str) -> None:
    """Fail where a non-null source has no target, for all ``(source, target)``
    pairs in one pass over ``df``. The full list is written to the checkpoint
    folder; the error (:class:`UnmappedValues`) lists it up to MAX_LISTED values
    a pair and names the table."""
    audit = df.select(F.explode(F.array_compact(_failed(checks))).alias("a")).select("a.*").distinct()
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/unmapped-{uuid.uuid4().hex}"
    audit.write.parquet(path)
    found = df.sparkSession.read.schema(audit.schema).parquet(path)
    counts = {(r.source, r.target): r.n for r in found.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return
    said = []
    for s, t in checks:
        if (s, t) in counts:
            own = found.where((F.col("source") == s) & (F.col("target") == t)).orderBy("value").limit(MAX_LISTED)
            said.append(f"{s} -> {t}: {', '.join(r.value for r in own.collect())}"
                        + (f", ... ({counts[s, t]} values)" if counts[s, t] > MAX_LISTED else ""))
    more = f" (all in {path})" if max(counts.values()) > MAX_LISTED else ""
    raise UnmappedValues(f"Unmapped values in {context}{more}: {'; '.join(said)}", path)


def write_counted(df: DataFrame, checks: Sequence[tuple[str, str]], write: Callable[[DataFrame], None]) -> int:
    """``write(df)``, and how many rows of it fail one of the checks.

    The rows are counted by the job that writes them; the plan of ``df`` runs
    once. A task that runs again may count its rows again, so the number says
    whether there are any, not how many.
    """
    unmapped = Observation()
    bad = F.exists(_failed(checks), lambda x: x.isNotNull())
    write(df.observe(unmapped, F.count(F.when(bad, F.lit(1))).alias("rows")))
    return unmapped.get["rows"]


def materialize_mapped(df: DataFrame, checks: Sequence[tuple[str, str]], context: str) -> DataFrame:
    """``df`` written to the checkpoint folder, or :class:`UnmappedValues` with
    the full list. Only where the write has counted unmapped rows does an audit
    read the written rows."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/mapped-{uuid.uuid4().hex}"
    unmapped = write_counted(df, checks, lambda rows: rows.write.parquet(path))
    written = spark.read.schema(df.schema).parquet(path)
    if unmapped:
        assert_all_mapped(written, checks, context)
    return written


def lookup_strict(df: DataFrame, dim: DataFrame, on, add: Sequence[str], context: str, *,
                  source: str | None = None, known_rows: int | None = None) -> DataFrame:
    """Lookup that fails when a non-null key finds no entry for an added column;
    the result is written once (see :func:`materialize_mapped`)."""
    out = lookup(df, dim, on, add, known_rows=known_rows)
    src = source or next(iter(_key_map(on)))
    return materialize_mapped(out, [(src, target) for target in add], context)


def compose_dims(left: DataFrame, right: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Chain two dictionaries (``a -> b`` with ``b -> c`` gives ``a -> b, c``)."""
    return left.join(bounded_broadcast(right), on, how)
