from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(col) -> Column:
    """A column name or Column as Column."""
    return col if isinstance(col, Column) else F.col(col)
