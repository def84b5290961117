"""Period column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# The month format of the sources (`%Y-%m`: four-digit year,
# month with one or two digits, nothing around them).
MONTH_PATTERN = "yyyy-M"
MONTH_SHAPE = r"^[0-9]{4}-[0-9]{1,2}$"


def parse_month(col) -> Column:
    """``YYYY-MM`` / ``YYYY-M`` text -> first day of the month; else null.

    The shape check runs first: it rejects malformed text cheaply (the
    parser would raise and catch per row) and keeps the year at four digits.
    """
    text = as_col(col).cast("string")
    return F.when(text.rlike(MONTH_SHAPE), F.try_to_timestamp(text, F.lit(MONTH_PATTERN)).cast("date"))


def parse_date(col) -> Column:
    """Lenient date parse of ISO text or a timestamp; unparsable -> null."""
    return as_col(col).try_cast("date")


def month_start(col) -> Column:
    """Month of a date or timestamp as the date of its first day."""
    return F.trunc(as_col(col).cast("date"), "month")


def iso_date(col) -> Column:
    """``YYYY-MM-DD`` text for export."""
    return F.date_format(as_col(col), "yyyy-MM-dd")


def month_token(year, month) -> Column:
    """``YYYY-MM`` request token from year and month numbers."""
    return F.format_string("%04d-%02d", as_col(year).cast("int"), as_col(month).cast("int"))
