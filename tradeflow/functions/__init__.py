"""Column -> Column expressions (all JVM-side, codegen-friendly)."""

from .arrays import chunk_array, mixed_radix, parse_years, strides, years_text
from .measures import nan_to_null, scale, to_measure
from .periods import iso_date, month_start, month_token, parse_date, parse_month
from .text import clean_label, form_encode, request_url, safe_stem

__all__ = [
    "chunk_array", "clean_label", "form_encode", "iso_date", "mixed_radix", "month_start",
    "month_token", "nan_to_null", "parse_date", "parse_month", "parse_years", "request_url",
    "safe_stem", "scale", "strides", "to_measure", "years_text",
]
