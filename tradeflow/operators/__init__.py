"""DataFrame -> DataFrame operators (usable with ``DataFrame.transform``)."""

from ._broadcast import MAX_BROADCAST_ROWS, bounded_broadcast
from .conform import combined_product_dim, conform_tyre, conform_vehicle, normalize_trade, strict_inline
from .facts import (align_measures, align_pair, enrich_partner, keep_latest, stack_measures, sum_measure,
                    tag, union_branches)
from .filters import date_floor, drop_missing, exclude_values, keep_values
from .lookup import (UnmappedValues, assert_all_mapped, assert_mapped, compose_dims, lookup, lookup_default, lookup_strict,
                     materialize_mapped, unmapped_values, write_counted)
from .ordering import order_columns, ordered, ordered_within
from .quality import measures_of, pad_columns, require_rows

__all__ = [
    "MAX_BROADCAST_ROWS", "UnmappedValues", "align_measures", "align_pair", "assert_all_mapped", "assert_mapped", "bounded_broadcast",
    "combined_product_dim", "compose_dims", "conform_tyre", "conform_vehicle", "date_floor", "drop_missing",
    "enrich_partner", "exclude_values", "keep_latest", "keep_values", "lookup", "lookup_default",
    "lookup_strict", "materialize_mapped", "measures_of", "normalize_trade", "order_columns", "ordered", "ordered_within",
    "pad_columns", "require_rows", "stack_measures", "strict_inline", "sum_measure", "tag", "union_branches",
    "unmapped_values", "write_counted",
]
