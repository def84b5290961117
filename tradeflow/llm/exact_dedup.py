"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries of the digests, one per partition and merged by a sum,
name every digest that may be frequent. The named ones are counted exactly and
the verified winners, a bounded number, are broadcast: their rows are decided
where they lie and never shuffled. All other digests, none of them frequent,
take an ordinary shuffle by digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import scratch, text_or_empty

#: Counters of one Misra-Gries summary.
COUNTERS = 1024


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # lower() on ASCII-only text changes A-Z alone and has a byte-wise fast path.
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, upper, upper.lower())))


def misra_gries(df: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """Merged Misra-Gries summary of ``column``: rows (column, estimate).

    ``frequency - rows / (counters + 1) <= estimate <= frequency`` for each
    value; values without a row have the estimate 0. Nulls are not counted.
    """
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            seen = pc.value_counts(batch.column(0).drop_null())
            for value, n in zip(seen.field(0).to_pylist(), seen.field(1).to_pylist()):
                held[value] = held.get(value, 0) + n
            if len(held) > counters:
                cut = sorted(held.values(), reverse=True)[counters]
                held = {value: n - cut for value, n in held.items() if n > cut}
        if held:
            yield pa.RecordBatch.from_pydict(
                {column: list(held), "estimate": pa.array(held.values(), pa.int64())})

    kind = df.schema[column].dataType.simpleString()
    partial = df.select(column).mapInArrow(summarise, f"`{column}` {kind}, estimate long")
    return partial.groupBy(column).agg(F.sum("estimate").alias("estimate"))


def exact_dedup(docs: DataFrame, carry: tuple[str, ...] = (), counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, text_sha256, keep_id, group_size, kept,
    and the columns named in ``carry``.

    Texts are equal when identical after lowering A-Z; a null text counts as
    empty. Of equal texts the row with the largest doc_id stays (null ids rank
    below all others); of repeated rows with that id exactly one is ``kept``,
    and keep_id is null only where the whole group has no id. ``.filter("kept")``
    is the deduplicated corpus. An empty table gives an empty result. Other
    input columns are not read, so their names cannot clash; ``carry`` may not
    name a result column.
    """
    rows = scratch(docs.select(
        "doc_id", *carry, F.sha2(ascii_lower(text_or_empty()), 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row_no")), "exact-dedup-digests")
    total = rows.count()
    # Estimates sum to at most total, so at most counters + 1 digests pass.
    named = (misra_gries(rows, "text_sha256", counters)
             .filter(F.col("estimate") >= total / (counters + 1)).select("text_sha256"))
    best = F.max(F.struct("doc_id", "row_no"))
    winners = scratch(
        rows.join(F.broadcast(named), "text_sha256")
        .groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("group_size"))
        .filter(F.col("group_size") >= max(2, 2 * total / (counters + 1))), "exact-dedup-winners")
    frequent = rows.join(F.broadcast(winners), "text_sha256")
    others = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    same = Window.partitionBy("text_sha256")
    others = others.withColumns({"best": best.over(same), "group_size": F.count("*").over(same)})
    return frequent.unionByName(others).select(
        "doc_id", *carry, "text_sha256", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("best.row_no") == F.col("row_no")).alias("kept"))
