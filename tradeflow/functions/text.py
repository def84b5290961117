"""Text column expressions: label cleaning, file stems, request URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Label-cleaning rules, applied in this order, written with
# Python `re` semantics; the label is trimmed afterwards.
LABEL_RULES = (
    r"\s*\(.*",
    r"\s*from\s+\d{4}.*?\)$",
    r"\s*->\s*\d{4}\)?$",
)

# Python's whitespace class for text is Unicode White_Space plus U+001C..U+001F.
_PY_SPACE = r"[\s\x{1c}-\x{1f}]"
# Literals one of the rules needs to match at all: labels without any of them
# skip the rule regexes.
_RULE_GUARDS = ("(", "from", "->")


def java_regex(python_pattern: str) -> str:
    """Java regex with the meaning the pattern has under Python `re` on text.

    ``(?d)``: only ``\\n`` ends a line (``.`` and ``$`` as in Python);
    ``(?U)``: ``\\s`` and ``\\d`` are Unicode classes, as in Python.
    """
    return "(?dU)" + python_pattern.replace(r"\s", _PY_SPACE)


_TRIM = r"(?U)\A" + _PY_SPACE + r"+|" + _PY_SPACE + r"+\z"


def py_strip(col) -> Column:
    """``str.strip()``: remove Python whitespace at both ends."""
    return F.regexp_replace(as_col(col), _TRIM, "")


def clean_label(col) -> Column:
    """Drop parenthesised notes and validity suffixes from a geo label.

    ``"Belgium (incl. Luxembourg 'LU' -> 1998)"`` -> ``"Belgium"``; null stays null.
    """
    raw = as_col(col).cast("string")
    out = raw
    for rule in LABEL_RULES:
        out = F.regexp_replace(out, java_regex(rule), "")
    needed = F.instr(raw, _RULE_GUARDS[0]) > 0
    for literal in _RULE_GUARDS[1:]:
        needed = needed | (F.instr(raw, literal) > 0)
    return py_strip(F.when(needed, out).otherwise(raw))


def safe_stem(col) -> Column:
    """File stem usable as a name: runs of other characters become ``_``."""
    cleaned = F.regexp_replace(as_col(col), r"[^A-Za-z0-9._-]+", "_")
    stripped = F.regexp_replace(cleaned, r"^_+|_+$", "")
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit("source"))


def form_encode(col) -> Column:
    """``application/x-www-form-urlencoded`` as Python's ``urlencode`` writes it.

    Java's encoder differs from Python's ``quote_plus`` only on ``~`` (kept by
    Python) and ``*`` (escaped by Python).
    """
    encoded = F.url_encode(as_col(col).cast("string"))
    return F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def query_param(name: str, value) -> Column:
    """One ``name=value`` pair, value encoded."""
    return F.concat(F.lit(name + "="), form_encode(value))


def repeated_param(name: str, values) -> Column:
    """``name=v1&name=v2...`` for an array column; empty string for an empty array."""
    return F.array_join(F.transform(as_col(values), lambda v: query_param(name, v)), "&")


def request_url(base_url, dataset_code, fmt, freq, flows, reporters, product,
                indicator, times) -> Column:
    """Data request URL: ``base/dataset?`` and the parameters in fixed order.

    Order: format, freq, flow*, reporter*, product, indicators, time*. Array
    parameters repeat the key once per element.
    """
    parts = F.array(
        query_param("format", as_col(fmt)),
        query_param("freq", as_col(freq)),
        repeated_param("flow", flows),
        repeated_param("reporter", reporters),
        query_param("product", as_col(product)),
        query_param("indicators", as_col(indicator)),
        repeated_param("time", times),
    )
    query = F.array_join(F.filter(parts, lambda p: p != F.lit("")), "&")
    base = F.regexp_replace(as_col(base_url), r"/+$", "")
    return F.concat(base, F.lit("/"), as_col(dataset_code), F.lit("?"), query)
