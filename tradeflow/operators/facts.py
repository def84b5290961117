"""Fact-table operators: snapshot dedupe, measure sums and alignment, unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import lookup_default


def tag(df: DataFrame, **values) -> DataFrame:
    """Add constant columns (``None`` gives a null string column)."""
    return df.withColumns({k: (F.lit(v) if v is not None else F.lit(None).cast("string"))
                           for k, v in values.items()})


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per business key: the one that sorts last by ``order``.

    ``order`` lists the tie-break columns, most significant first (source
    modification time, source name, then the position columns of the row in its
    source). Nulls sort last, so a null order value counts as latest. The plan
    is ``row_number() = 1``: Spark limits each key to one row on both sides of
    the shuffle (WindowGroupLimit), so a hot key sends one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1)
              .drop("__rn"))


def _zero_sum(col: str) -> Column:
    return F.coalesce(F.sum(col), F.lit(0)).alias(col)


def sum_measure(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Group sum of one measure; null keys form groups; an all-null group sums to 0."""
    return df.groupBy(*keys).agg(_zero_sum(measure))


def stack_measures(sides: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Put separately reported measures in one relation, one flag per side.

    ``sides`` maps measure column -> DataFrame holding ``keys`` and that column.
    Each side's rows carry ``__has_<measure>`` = true and nulls for the others.
    """
    parts = []
    for measure, frame in sides.items():
        cols = [F.col(k) for k in keys]
        for other in sides:
            if other == measure:
                cols += [F.col(measure), F.lit(True).alias(f"__has_{measure}")]
            else:
                cols += [F.lit(None).cast(frame.schema[measure].dataType).alias(other),
                         F.lit(False).alias(f"__has_{other}")]
        parts.append(frame.select(*cols))
    return reduce(lambda a, b: a.unionByName(b), parts)


def align_measures(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Inner alignment of measures on all keys, null key equal to null key.

    Input is :func:`stack_measures` output (or one relation carrying the
    ``__has_<m>`` flags). One group-by sums every measure and keeps the groups
    present on every side, so there is a single shuffle with partial (map-side)
    aggregation, where a join of two aggregates would need several.
    """
    aggs = [_zero_sum(m) for m in measures]
    flags = [F.bool_or(f"__has_{m}").alias(f"__has_{m}") for m in measures]
    out = df.groupBy(*keys).agg(*aggs, *flags)
    present = reduce(lambda a, b: a & b, [F.col(f"__has_{m}") for m in measures])
    return out.where(present).drop(*[f"__has_{m}" for m in measures])


def align_pair(left: DataFrame, right: DataFrame, keys: Sequence[str],
               left_measure: str = "value", right_measure: str = "weight") -> DataFrame:
    """Sum both measures per key and keep keys present on both sides."""
    stacked = stack_measures({left_measure: left, right_measure: right}, keys)
    return align_measures(stacked, keys, [left_measure, right_measure])


def union_branches(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union by column name (missing columns as null when ``allow_missing``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def enrich_partner(df: DataFrame, partner_dim: DataFrame, partner: str = "partner",
                   default: str = "Unknown", known_rows: int | None = None) -> DataFrame:
    """Partner -> ``partner_continent``, ``partner_sub_region``; unmapped -> default."""
    return lookup_default(
        df, partner_dim, {partner: partner_dim.columns[0]},
        {"partner_continent": default, "partner_sub_region": default},
        known_rows=known_rows,
    )
