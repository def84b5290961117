"""Sparse JSON-stat cube operators: decode, latest period, slice statistics, conform."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_label, parse_month, strides
from .filters import drop_missing, keep_values
from .lookup import lookup

# Cube dimension ids renamed in the long table.
DIMENSION_ALIASES = {"indicators": "indicator"}


def _alias(dim: Column, aliases: Mapping[str, str]) -> Column:
    out = dim
    for src, dst in aliases.items():
        out = F.when(dim == F.lit(src), F.lit(dst)).otherwise(out)
    return out


def _by_position(index: Column, size: Column, value) -> Column:
    """An array with ``value(code)`` at each position 0..size-1; null where no
    category has the position."""
    pairs = F.array_sort(F.transform(F.map_entries(index), lambda e: F.struct(
        e["value"].alias("pos"), e["key"].alias("code"))))
    dense = (F.size(pairs) == size) & (F.element_at(pairs, -1)["pos"] == size - 1) & (pairs[0]["pos"] == 0)
    # With gaps, positions are looked up one by one; that is rare and per document.
    at = F.map_from_entries(pairs)
    return (F.when(size == 0, F.array().cast("array<string>"))
            .when(dense, F.transform(pairs, lambda p: value(p["code"])))
            .otherwise(F.transform(F.sequence(F.lit(0).cast("long"), size - 1),
                                   lambda p: value(F.try_element_at(at, p)))))


BASE_COLUMNS = ("dataset_code", "dataset_label", "source_updated", "source_path")


def _codes_of(d: Column, size: Column) -> Column:
    return _by_position(F.col("dimension")[d]["category"]["index"], size, lambda c: c)


def _labels_of(d: Column, size: Column) -> Column:
    category = F.col("dimension")[d]["category"]
    return _by_position(category["index"], size, lambda c: F.coalesce(F.try_element_at(category["label"], c), c))


def _base() -> list[Column]:
    return [F.coalesce(F.col("extension.datasetId"), F.lit("")).alias("dataset_code"),
            F.coalesce(F.col("label"), F.lit("")).alias("dataset_label"),
            F.coalesce(F.col("updated"), F.lit("")).alias("source_updated"), F.col("source_path")]


def _position(stride: Column, size: Column) -> Column:
    return F.pmod(F.call_function("div", F.col("flat_index"), stride), size).cast("int")


def _layout_columns(aliases: Mapping[str, str], dims: Sequence[str]) -> list[Column]:
    names = F.transform("id", lambda d: _alias(d, aliases))
    layout = []
    for k, name in enumerate(dims):
        # get() by a position of -1, where the dimension is absent, is null.
        i = F.array_position(names, F.lit(name)).cast("int") - 1
        d, size = F.get("id", i), F.get("size", i)
        layout += [F.get(strides("size"), i).alias(f"__stride{k}"), size.alias(f"__size{k}"),
                   _codes_of(d, size).alias(f"__codes{k}"), _labels_of(d, size).alias(f"__labels{k}")]
    return layout


def cube_layout(cubes: DataFrame, aliases: Mapping[str, str] = DIMENSION_ALIASES, dims: Sequence[str] = ()) -> DataFrame:
    """Per document: what :func:`resolve_cells` needs to place the cells of ``dims``."""
    return cubes.select(*_base(), *_layout_columns(aliases, dims))


def resolve_cells(cells: DataFrame, dims: Sequence[str], value: Column, status: Column) -> DataFrame:
    """Codes and labels of cells that carry ``flat_index`` and their document's :func:`cube_layout`."""
    columns = []
    for k, name in enumerate(dims):
        at = _position(F.col(f"__stride{k}"), F.col(f"__size{k}"))
        columns += [F.get(f"__codes{k}", at).alias(f"{name}_code"), F.get(f"__labels{k}", at).alias(f"{name}_label")]
    return cells.select(*BASE_COLUMNS, "flat_index", value.alias("value"),
                        F.coalesce(status, F.lit("")).alias("status"), *columns)


def decode_cube(cubes: DataFrame, aliases: Mapping[str, str] = DIMENSION_ALIASES,
                dims: Sequence[str] | None = None) -> DataFrame:
    """One row per stored cell: flat index -> coordinates -> codes and labels.

    Per document (before the cells are exploded) each dimension's categories
    are laid out by position once, so a cell resolves a code by array index.
    A label missing for a code falls back to the code; a missing status is ``''``.
    A document larger than a task is read by
    :func:`~tradeflow.sources.large_cubes.scan_large_cubes` instead.

    With ``dims`` (names after aliasing) only these are resolved, as plain
    columns ``<dim>_code`` and ``<dim>_label``, null where a document lacks the
    dimension; filters on codes then run before labels are looked up. Without,
    all dimensions of every document go to the maps ``codes`` and ``labels``;
    how many there are is read from the documents first.
    Output: dataset_code, dataset_label, source_updated, source_path,
    flat_index, value, status, and the dimensions.
    """
    names = F.transform("id", lambda d: _alias(d, aliases))
    every = F.arrays_zip(F.col("id").alias("d"), F.col("size").alias("n"))
    if dims is None:
        layout = [names.alias("__names"), strides("size").alias("__strides"), F.col("size").alias("__sizes"),
                  F.transform(every, lambda x: _codes_of(x["d"], x["n"])).alias("__codes"),
                  F.transform(every, lambda x: _labels_of(x["d"], x["n"])).alias("__labels")]
    else:
        layout = _layout_columns(aliases, dims)
    docs = cubes.select(
        *_base(), *layout,
        # Value and status maps zipped once per document (hashed key match), so
        # each cell carries its own status and no map is scanned per cell.
        F.map_zip_with(
            F.transform_values("value", lambda _k, v: F.struct(v.alias("v"))),
            F.coalesce(F.col("status"), F.create_map().cast("map<string,string>")),
            lambda _k, a, b: F.struct(a.alias("a"), b.alias("s")),
        ).alias("__cells"),
    )
    # explode_outer: from an explode the optimiser would infer a filter on
    # __cells below this projection and evaluate the whole document twice.
    cells = docs.select("*", F.explode_outer("__cells").alias("__key", "__cell")).drop("__cells")
    cells = cells.where(F.col("__cell.a").isNotNull()).withColumn("flat_index", F.col("__key").cast("long"))
    if dims is not None:
        return resolve_cells(cells, dims, F.col("__cell.a.v"), F.col("__cell.s"))
    base = [*BASE_COLUMNS, "flat_index", F.col("__cell.a.v").alias("value"),
            F.coalesce(F.col("__cell.s"), F.lit("")).alias("status")]
    most = cubes.agg(F.max(F.size("id"))).first()[0] or 0
    n = F.size("__names")
    codes, labels = [], []
    for i in map(F.lit, range(most)):  # null past a document's own dimensions
        at = _position(F.get("__strides", i), F.get("__sizes", i))
        codes.append(F.get(F.get("__codes", i), at))
        labels.append(F.get(F.get("__labels", i), at))
    decoded = cells.select(
        *base,
        F.map_from_arrays(F.col("__names"), F.slice(F.array(*codes), 1, n)).alias("codes"),
        F.map_from_arrays(F.col("__names"), F.slice(F.array(*labels), 1, n)).alias("labels"),
        # Nondeterministic column: later filters on codes stay above this
        # projection instead of decoding again inside the filter.
        F.spark_partition_id().alias("__part"),
    )
    return decoded.where(F.col("__part") >= 0).drop("__part")


def cube_columns(cube_long: DataFrame, dims: Sequence[str], keep: Sequence[str] = (
        "dataset_code", "dataset_label", "source_updated", "source_path", "value", "status")) -> DataFrame:
    """Project ``<dim>_code`` / ``<dim>_label`` columns for the named dimensions."""
    cols = [F.col(c) for c in keep]
    for d in dims:
        cols += [F.col("codes")[d].alias(f"{d}_code"), F.col("labels")[d].alias(f"{d}_label")]
    return cube_long.select(*cols)


def latest_period(cubes: DataFrame) -> DataFrame:
    """Latest period label per document: max label of dimension ``time``.

    An absent (or category-less) ``time`` falls back to ``time_period``.
    ``latest_period`` is null when neither exists or there are no labels;
    :func:`check_latest_periods` turns that into an error.
    """
    dim = F.col("dimension")
    time = F.when(dim["time"]["category"].isNotNull(), dim["time"]).otherwise(dim["time_period"])
    labels = time["category"]["label"]
    return cubes.select(
        F.coalesce(F.col("extension.datasetId"), F.lit("")).alias("dataset_code"),
        F.array_max(F.map_values(labels)).alias("latest_period"),
        F.coalesce(F.col("updated"), F.lit("")).alias("updated"),
        F.col("source_path"),
        F.when(time.isNull(), F.lit("it has no dimension of time"))
         .when(F.coalesce(F.cardinality(labels), F.lit(0)) == 0, F.lit("its time has no labelled period"))
         .alias("error"),
    )


def check_latest_periods(periods: DataFrame) -> DataFrame:
    """Fail when a document had no usable time dimension."""
    bad = [f"{r.source_path} ({r.error})" for r in
           periods.where(F.col("error").isNotNull()).orderBy("source_path").toLocalIterator()]
    if bad:
        raise ValueError(f"{len(bad)} documents name no latest period: {', '.join(bad)}")
    return periods.drop("error")


def cube_cell_counts(cubes: DataFrame, keep: Sequence[str | Column] = ()) -> DataFrame:
    """Per document: stored cells, decodable rows and the update stamp, and the
    columns ``keep``."""
    return cubes.select(
        *keep,
        "source_path",
        F.coalesce(F.col("updated"), F.lit("")).alias("response_updated"),
        F.coalesce(F.cardinality("value"), F.lit(0)).cast("long").alias("cell_count"),
        F.when(F.col("id").isNotNull(), F.coalesce(F.cardinality("value"), F.lit(0)))
         .otherwise(F.lit(0)).cast("long").alias("row_count"),
    )


CONFORM_DIMS = ("indicator", "product", "reporter", "partner", "time")


def conform_cube(cube_long: DataFrame, indicator_code: str, measure: str, product_codes: DataFrame,
                 hs_dims: Sequence[DataFrame] = (), exclude_codes: Sequence[str] = ()) -> DataFrame:
    """Cube cells of one indicator and product set -> stage rows.

    ``cube_long`` has the columns of ``decode_cube(..., dims=CONFORM_DIMS)``, or
    the maps of a full decode.
    ``product_codes`` is a one-column dimension of wanted codes; ``hs_dims``
    are dictionaries keyed by ``hs_code`` (e.g. category, general category)
    attached with a plain lookup (an unmapped code stays null).
    """
    cells = cube_long if "indicator_code" in cube_long.columns else cube_columns(cube_long, CONFORM_DIMS, keep=("value",))
    cells = keep_values(cells.where(F.col("indicator_code") == F.lit(indicator_code)), "product_code",
                        product_codes)
    if exclude_codes:
        cells = cells.where(~F.col("product_code").isin(list(exclude_codes)))
    out = cells.select(
        clean_label("reporter_label").alias("country"),
        parse_month("time_code").alias("date"),
        F.col("product_label").alias("product"),
        F.col("indicator_code").alias("indicator"),
        clean_label("partner_label").alias("partner"),
        F.col("value").alias(measure),
        F.col("product_code").alias("hs_code"),
    )
    out = drop_missing(out, ["date", "country", "partner", measure])
    out = out.withColumns({"year": F.year("date"), "month": F.month("date")})
    for d in hs_dims:
        out = lookup(out, d, "hs_code")
    return out
