"""Consecutive positions in a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._broadcast import bounded_broadcast
from .ordering import order_columns


def with_global_rank(df: DataFrame, keys: Sequence[str], rank_col: str = "rank",
                     numeric: Sequence[str] = ()) -> DataFrame:
    """Sort globally and number rows 1..n in that order.

    ``row_number()`` over an unpartitioned window would pull every row into one
    task. Instead: range-partitioned sort; the id Spark assigns within each
    sorted partition gives the local position; per-partition counts (one row
    per partition) give the offsets. Equal keys always land in one partition,
    so the counts do not depend on how ties are ordered. The numbered sort is
    checkpointed (to ``spark.checkpoint.dir``) so both uses see the same
    partitions; the result keeps the sorted order partition by partition.
    """
    sorted_df = df.orderBy(*order_columns(keys, numeric))
    tagged = sorted_df.withColumns({
        "__pid": F.spark_partition_id(),
        "__mid": F.monotonically_increasing_id(),
    }).checkpoint(eager=True)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__offset"),
    )
    # One row per partition of the sort: bounded by the shuffle partition count.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = tagged.join(bounded_broadcast(offsets, known_rows=parts), "__pid", "left")
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return (ranked.withColumn(rank_col, F.coalesce(F.col("__offset"), F.lit(0)) + local + 1)
                  .drop("__pid", "__mid", "__offset"))
