"""Row filters with pandas' null behaviour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._broadcast import bounded_broadcast


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with null (or NaN) in any of ``subset``."""
    return df.dropna(how="any", subset=list(subset))


def exclude_values(df: DataFrame, col: str, values) -> DataFrame:
    """Drop rows whose ``col`` is in ``values`` (a list or a one-column DataFrame).

    Null ``col`` rows are kept (``~isin`` on a missing value is true in pandas).
    """
    if isinstance(values, DataFrame):
        other = values.select(F.col(values.columns[0]).alias(col))
        return df.join(bounded_broadcast(other), col, "left_anti")
    return df.where(F.coalesce(~F.col(col).isin(list(values)), F.lit(True)))


def keep_values(df: DataFrame, col: str, values) -> DataFrame:
    """Keep rows whose ``col`` is in ``values``; null ``col`` rows are dropped."""
    if isinstance(values, DataFrame):
        other = values.select(F.col(values.columns[0]).alias(col))
        return df.join(bounded_broadcast(other), col, "left_semi")
    return df.where(F.col(col).isin(list(values)))


def date_floor(df: DataFrame, col: str, day: str) -> DataFrame:
    """Keep rows with ``col >= day``; null dates are dropped."""
    return df.where(F.col(col) >= F.lit(day).cast("date"))
