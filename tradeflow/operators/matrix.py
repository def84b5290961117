"""Matrix-shaped sheets (one column per partner) to long rows.

Input is a sparse *cells* table, one row per non-empty cell:
``source_name, source_path, source_mtime, sheet_ord, sheet, row, col, text``
(0-based row/col). Layout of a tab: metadata in rows 4-7 (value in column 2,
else column 0), partner header in row 9, a units row at 10 that is dropped,
data from row 11: the first two non-empty columns hold country and month, the
others one partner each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import to_measure

HEADER_ROW = 9
# Metadata rows of a tab and the fields they hold.
META_ROWS = {4: "frequency", 5: "product", 6: "flow", 7: "indicator"}
SHEET_PREFIX = "Sheet"
SHEET_KEYS = ["source_path", "sheet_ord"]


# Columns per bucket when numbering repeated headers (bounds one window task).
HEADER_BUCKET = 4096


def dedupe_headers(headers: DataFrame, keys: Sequence[str], text: str = "text", col: str = "col",
                   out: str = "header") -> DataFrame:
    """Repeated header texts get ``.1``, ``.2`` ... in column order, as a sheet reader names them.

    Two levels, so no single task numbers a whole group: row numbers within
    buckets of ``HEADER_BUCKET`` columns, plus each bucket's offset from the
    running count of earlier buckets (one row per bucket).
    """
    group = [*keys, text]
    b = headers.withColumn("__bucket", F.floor(F.col(col) / F.lit(HEADER_BUCKET)))
    local = b.withColumn("__rn", F.row_number().over(Window.partitionBy(*group, "__bucket").orderBy(col)))
    counts = b.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(
        Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = local.join(offsets.select(*group, "__bucket", "__off"), [*group, "__bucket"])
    rn = F.col("__off") + F.col("__rn") - 1
    return ranked.withColumn(out, F.when(rn == 0, F.col(text)).otherwise(
        F.concat(F.col(text), F.lit("."), rn.cast("string")))).drop("__bucket", "__rn", "__off")


def sheet_metadata(cells: DataFrame, meta_rows: Mapping[int, str] = META_ROWS,
                   keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """Per tab: each metadata field from column 2 of its row, else column 0."""
    def cell(row: int, col: int) -> Column:
        return F.max(F.when((F.col("row") == row) & (F.col("col") == col), F.col("text")))

    meta = cells.where(F.col("row").isin(list(meta_rows)) & F.col("col").isin(0, 2))
    return meta.groupBy(*keys).agg(*[F.coalesce(cell(r, 2), cell(r, 0)).alias(name) for r, name in meta_rows.items()])


#: Rows of a tab that one task takes at a time.
ROW_RANGE = 1024


def _tab_layouts(cells: DataFrame, header_row: int, meta_rows: Mapping[int, str]) -> DataFrame:
    """One row per complete tab: metadata, the columns of country and month,
    ``__columns`` (per sheet column its partner and position, null elsewhere)
    and ``__ranges`` (the row ranges that hold data).

    A workbook's layout comes from one aggregate over its cells: sets of header
    cells, used columns, metadata cells and row ranges, never of data cells, so
    they are as large as sheets are wide. All that follows is keyed by workbook
    and stays where that aggregate put it.
    """
    is_data = F.col("row") > F.lit(header_row + 1)
    fact = F.struct(F.col("sheet_ord"), F.col("row"), F.col("col"), F.col("text"))
    none = F.lit(None)
    # Kinds of facts: h a header cell, m a metadata cell, c a used column, r a row
    # range, w a tab that is wider than one column.
    facts = cells.groupBy("source_path").agg(
        F.collect_set(F.when(F.col("row") == header_row, fact)).alias("h"),
        F.collect_set(F.when(F.col("row").isin(list(meta_rows)) & F.col("col").isin(0, 2), fact)).alias("m"),
        F.collect_set(F.when(is_data, F.struct("sheet_ord", "col"))).alias("c"),
        F.collect_set(F.when(is_data, F.struct("sheet_ord", _range("row").alias("row")))).alias("r"),
        F.collect_set(F.when(F.col("col") >= 1, F.col("sheet_ord"))).alias("w"))

    def as_facts(kind: str, row, col, text, sheet=lambda x: x["sheet_ord"]):
        return F.transform(kind, lambda x: F.struct(
            F.lit(kind).alias("kind"), sheet(x).cast("int").alias("sheet_ord"), row(x).cast("int").alias("row"),
            col(x).cast("int").alias("col"), text(x).cast("string").alias("text")))

    rows = facts.select("source_path", F.explode(F.concat(
        as_facts("h", lambda x: x["row"], lambda x: x["col"], lambda x: x["text"]),
        as_facts("m", lambda x: x["row"], lambda x: x["col"], lambda x: x["text"]),
        as_facts("c", lambda x: none, lambda x: x["col"], lambda x: none),
        as_facts("r", lambda x: x["row"], lambda x: none, lambda x: none),
        as_facts("w", lambda x: none, lambda x: none, lambda x: none, lambda x: x))).alias("f")).select("source_path", "f.*")
    # A cell that a damaged sheet stores twice counts once.
    twice = Window.partitionBy("source_path", "sheet_ord", "kind", "row", "col").orderBy("text")
    rows = rows.withColumn("__nth", F.row_number().over(twice)).where("__nth = 1").drop("__nth")
    # Repeated headers of a tab get .1, .2 ... in column order.
    nth = F.row_number().over(Window.partitionBy("source_path", "sheet_ord", "kind", "text").orderBy("col")) - 1
    rows = rows.withColumn("name", F.when(F.col("kind") == "h", F.when(nth == 0, F.col("text")).otherwise(
        F.concat("text", F.lit("."), nth.cast("string")))))

    def of(kind: str, value):
        return F.when(F.col("kind") == kind, value)

    def meta(row: int, col: int) -> Column:
        return F.max(of("m", F.when((F.col("row") == row) & (F.col("col") == col), F.col("text"))))

    tabs = (rows.groupBy("source_path", "sheet_ord").agg(
                F.array_sort(F.collect_list(of("c", F.col("col")))).alias("__used"),
                F.map_from_entries(F.collect_list(of("h", F.struct("col", "name")))).alias("__names"),
                F.collect_list(of("r", F.col("row"))).alias("__ranges"),
                F.max(F.col("kind") == "w").alias("__wide"),
                *[F.coalesce(meta(r, 2), meta(r, 0)).alias(name) for r, name in meta_rows.items()])
            .where(F.col("__wide") & (F.size("__used") > 2)))
    # Partners of the value columns; positions count the partners of a workbook as first seen.
    partners = tabs.select("*", F.explode(F.slice("__used", 3, F.size("__used"))).alias("__col")).withColumn(
        "__partner", F.coalesce(F.try_element_at("__names", F.col("__col")),
                                F.concat(F.lit("Unnamed: "), F.col("__col").cast("string"))))
    partners = partners.withColumn("__first", F.min(F.struct("sheet_ord", "__col")).over(
        Window.partitionBy("source_path", "__partner")))
    partners = partners.withColumn(
        "__ord", F.dense_rank().over(Window.partitionBy("source_path").orderBy("__first")) - 1)
    kept = ["__used", "__ranges", *meta_rows.values()]
    layout = partners.groupBy("source_path", "sheet_ord").agg(
        *[F.first(c).alias(c) for c in kept],
        F.map_from_entries(F.collect_list(F.struct("__col", F.struct(
            F.col("__partner").alias("partner"), F.col("__ord").alias("partner_ord"))))).alias("__by_col"))
    columns = F.transform(F.sequence(F.lit(0), F.element_at("__used", -1)), lambda c: F.try_element_at("__by_col", c))
    return layout.select("source_path", "sheet_ord", F.element_at("__used", 1).alias("__country_col"),
                         F.element_at("__used", 2).alias("__date_col"), *meta_rows.values(),
                         columns.alias("__columns"), "__ranges")


def _range(row: str) -> Column:
    return F.floor(F.col(row) / F.lit(ROW_RANGE)).cast("int")


def matrix_to_long(cells: DataFrame, measure: str = "value", header_row: int = HEADER_ROW,
                   meta_rows: Mapping[int, str] = META_ROWS, sheet_prefix: str = SHEET_PREFIX) -> DataFrame:
    """Unpivot matrix tabs into ``country, date, partner, <measure>`` rows.

    Only tabs whose name starts with ``sheet_prefix`` are read; a tab whose
    data block has fewer than 2 rows or 2 columns is skipped. Only stored cells
    become rows (an empty cell would give a null measure, which every consumer
    drops). Lineage columns (source, sheet, row, ``partner_ord``) order
    duplicates for :func:`~tradeflow.operators.facts.keep_latest`;
    ``date_kind`` is ``'date'`` when the month cell was a date-formatted
    number (see :func:`~tradeflow.operators.conform.normalize_trade`).
    ``partner_ord`` is the first-seen position of the partner header in the
    workbook (tabs in order, columns left to right).

    The cells move once: dealt by (workbook, tab, row range), so a large tab is
    many tasks, they meet their tab's layout and give each row its country and
    month. ``cells`` is read twice and should be a written table.
    """
    if "kind" not in cells.columns:
        cells = cells.withColumn("kind", F.lit(None).cast("string"))
    c = cells.where(F.col("sheet").startswith(sheet_prefix) & F.col("text").isNotNull()
                    & (F.col("text") != F.lit("")))
    keys = [*SHEET_KEYS, "__range"]
    layouts = _tab_layouts(c, header_row, meta_rows).withColumn("__range", F.explode("__ranges")).drop("__ranges")
    data = c.where(F.col("row") > F.lit(header_row + 1)).withColumn("__range", _range("row")).join(layouts, keys)
    at = F.get("__columns", F.col("col"))
    data = data.select(*keys, "source_name", "source_mtime", "sheet", "row", "col", "text", "kind", *meta_rows.values(),
                       "__country_col", "__date_col", at["partner"].alias("partner"),
                       at["partner_ord"].alias("partner_ord"))
    by_row = Window.partitionBy(*keys, "row")
    data = data.withColumns({
        "country": F.max(F.when(F.col("col") == F.col("__country_col"), F.col("text"))).over(by_row),
        "date": F.max(F.when(F.col("col") == F.col("__date_col"), F.col("text"))).over(by_row),
        "date_kind": F.max(F.when(F.col("col") == F.col("__date_col"), F.col("kind"))).over(by_row),
    })
    # The columns of country and month have no partner.
    values = data.where(F.col("partner").isNotNull())
    return values.select(
        "source_name", "source_path", "source_mtime", "sheet_ord", "sheet", "row",
        "country", "date", "date_kind", *meta_rows.values(), "partner", "partner_ord",
        to_measure("text").alias(measure),
    )


def unpivot_measures(wide: DataFrame, ids: Sequence[str], variable: str = "partner",
                     value: str = "value", columns: Sequence[str] | None = None) -> DataFrame:
    """Wide table (one column per partner) -> long ``ids, variable, value``.

    Values are coerced with :func:`~tradeflow.functions.to_measure` (``":"`` and
    unparsable text become null).
    """
    cols = [c for c in (columns or wide.columns) if c not in ids]
    text = wide.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    long = text.unpivot(list(ids), [F.col(f"`{c}`") for c in cols], variable, "__text")
    return long.select(*ids, variable, to_measure("__text").alias(value))
