"""Output orders (nulls last, code-point string order)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_columns(keys: Sequence[str], numeric: Sequence[str] = ()) -> list[Column]:
    """Sort columns; ``numeric`` keys are text codes sorted by their number first."""
    cols: list[Column] = []
    for k in keys:
        if k in numeric:
            cols.append(F.col(k).try_cast("decimal(38,0)").asc_nulls_last())
        cols.append(F.col(k).asc_nulls_last())
    return cols


def ordered(df: DataFrame, keys: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """Global order (a range-partitioned sort)."""
    return df.orderBy(*order_columns(keys, numeric))


def ordered_within(df: DataFrame, keys: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """Order inside each partition only (per-year files need no global sort)."""
    return df.sortWithinPartitions(*order_columns(keys, numeric))
