"""Data-quality checks that stop a job."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The measures, and the word for both.
MEASURES = ("value", "weight")
BOTH = "all"


def measures_of(choice: str) -> tuple[str, ...]:
    """The measures that a choice stands for, blanks and case aside."""
    chosen = MEASURES if choice.strip().lower() == BOTH else tuple(m for m in MEASURES if m == choice.strip().lower())
    if not chosen:
        raise ValueError(f"no measure {choice!r}; choose one of {', '.join(MEASURES)} or {BOTH}")
    return chosen


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail when ``df`` has no rows (reads at most one row)."""
    if df.isEmpty():
        raise RuntimeError(message)
    return df


def pad_columns(df: DataFrame, columns, fill: str = "") -> DataFrame:
    """Project ``columns`` in order; absent ones are added as ``fill`` and nulls
    in text columns become ``fill`` (a column-complete manifest)."""
    from pyspark.sql import functions as F

    present = set(df.columns)
    out = []
    for c in columns:
        if c not in present:
            out.append(F.lit(fill).alias(c))
        elif dict(df.dtypes)[c] == "string":
            out.append(F.coalesce(F.col(c), F.lit(fill)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
