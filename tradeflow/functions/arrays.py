"""Array column expressions: year sets, chunking, cube strides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def years_text(years) -> Column:
    """Set of years -> ``"2017|2018"`` (sorted, distinct; empty set -> ``""``)."""
    arr = F.array_sort(F.array_distinct(F.filter(as_col(years), lambda y: y.isNotNull())))
    return F.coalesce(F.array_join(arr, "|"), F.lit(""))


def parse_years(text) -> Column:
    """``"2017|2018"`` -> sorted distinct ``array<int>``; ``""``/null -> empty."""
    parts = F.filter(F.split(F.coalesce(as_col(text), F.lit("")), r"\|"), lambda p: p != F.lit(""))
    return F.array_sort(F.array_distinct(F.transform(parts, lambda p: p.cast("int"))))


def chunk_array(arr, size) -> Column:
    """Split an array into consecutive chunks of ``size``; ``size <= 0`` -> one chunk.

    An empty array gives no chunks.
    """
    a = as_col(arr)
    n = F.when(as_col(size) > 0, as_col(size)).otherwise(F.greatest(F.size(a), F.lit(1)))
    count = F.call_function("div", F.size(a) + n - 1, n)
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1))
    chunks = F.transform(starts, lambda i: F.slice(a, i * n + 1, n))
    # CASE evaluates lazily, so the sequence is only built for non-empty arrays.
    return F.coalesce(chunks, F.slice(F.array(a), 1, 0))


def strides(sizes) -> Column:
    """Row-major strides of a cube: product of the sizes to the right of each axis."""
    s = as_col(sizes)
    return F.transform(
        s,
        lambda _x, i: F.aggregate(F.slice(s, i + 2, F.size(s)), F.lit(1).cast("long"),
                                  lambda acc, y: acc * y.cast("long")),
    )


def mixed_radix(flat_index, sizes, stride=None) -> Column:
    """Flat cell index -> coordinate per axis: ``(k div stride) mod size``.

    Pass precomputed ``stride`` (see :func:`strides`) when many indexes share
    one shape, e.g. all cells of a document.
    """
    s = as_col(sizes)
    st = as_col(stride) if stride is not None else strides(s)
    k = as_col(flat_index).cast("long")
    return F.transform(
        s, lambda size, i: (F.call_function("div", k, F.element_at(st, i + 1)) % size.cast("long")).cast("int"))
