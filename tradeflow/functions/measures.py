"""Numeric coercion with pandas ``to_numeric(errors="coerce")`` results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed value: the number forms accepted; anything else (":", "1,234", "1d",
# "nan", "0x1A", "") becomes null.
NUMBER_FORM = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


def to_measure(col) -> Column:
    """Text cell -> double; missing marker and unparsable text -> null."""
    text = as_col(col).cast("string")
    return F.when(text.rlike(NUMBER_FORM), text.try_cast("double"))


def nan_to_null(col) -> Column:
    """NaN -> null, so sums skip it as pandas does (Spark's sum keeps NaN)."""
    c = as_col(col)
    return F.when(~F.isnan(c), c)


def scale(col, factor) -> Column:
    """Unit conversion (100 kg -> kg is ``factor=100``)."""
    return as_col(col) * F.lit(factor)
