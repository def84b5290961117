"""Sparse JSON-stat cubes from long rows: the inverse of ``decode_cube``.

Documents are built as ordered pieces of text, each of a bounded number of
categories or cells, so no document is ever one row or one group. Pieces are
written to one file per document (:func:`write_documents`) or, for small ones,
joined to a row (:func:`document_rows`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ._broadcast import bounded_broadcast
from .ranking import with_global_rank

#: Cells, and categories of a dimension, that one piece of a document holds at most.
CELLS_A_PIECE = 8192
CATEGORIES_A_PIECE = 4096
#: Order of the sections of a document.
HEAD, DIMENSIONS, VALUES, STATUSES, TAIL = range(5)


@dataclass(frozen=True)
class CubeDim:
    """One dimension of a cube and the column of the cells that holds its codes.

    ``categories`` (``code``, ``label`` and optionally ``pos``) are the same in
    every document; without ``pos`` they take their place in the order of the
    codes. Without ``categories`` a document has the codes that its cells hold,
    labelled by themselves. A null label is left out of the document.
    """
    name: str
    code: str
    categories: DataFrame | None = None


def dense_positions(categories: DataFrame) -> DataFrame:
    """``code, label, pos``: positions 0, 1, ... in the order of the codes (a
    range-partitioned rank, no single-task window)."""
    ranked = with_global_rank(categories.select("code", "label"), ["code"], "__rank")
    return ranked.select("code", "label", (F.col("__rank") - 1).alias("pos"))


def _body(entries: Column) -> Column:
    """``"k":v,"k":v`` of an array of (key, value) structs."""
    text = F.to_json(F.map_from_entries(entries))
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _placed(cells: DataFrame, doc: Sequence[str], dims: Sequence[CubeDim]
            ) -> tuple[DataFrame, list[tuple[DataFrame, Row | None]], DataFrame]:
    """Cells with ``__flat``; per dimension (doc..., code, label, pos), or (code,
    label, pos) and how far its positions go; documents with ``__sizes``."""
    # Everything below reads the cells and the documents several times.
    cells = cells.checkpoint()
    tables, sizes, documents = [], [], cells.select(*doc).distinct().checkpoint()
    for k, dim in enumerate(dims):
        if dim.categories is None:
            own = cells.select(*doc, F.col(dim.code).cast("string").alias("code")).distinct()
            own = own.withColumn("pos", (F.dense_rank().over(Window.partitionBy(*doc).orderBy("code")) - 1).cast("long")).checkpoint()
            tables.append((own.withColumn("label", F.col("code")), None))
            counted = own.groupBy(*doc).agg(F.count(F.lit(1)).alias(f"__n{k}"))
            documents = documents.join(counted, list(doc))
            keys = [*doc, dim.code]
        else:
            own = dim.categories if "pos" in dim.categories.columns else dense_positions(dim.categories)
            own = own.select(F.col("code").cast("string").alias("code"), "label", F.col("pos").cast("long").alias("pos")).checkpoint()
            extent = own.agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"),
                             F.min(F.when(F.col("label").isNotNull(), F.col("pos"))).alias("labelled")).first()
            tables.append((own, extent))
            documents = documents.withColumn(f"__n{k}", F.lit(extent.n).cast("long"))
            keys = [dim.code]
        side = own.select(*[c for c in doc if c in own.columns], F.col("code").alias(dim.code), F.col("pos").alias(f"__p{k}"))
        known = tables[-1][1]
        cells = cells.join(bounded_broadcast(side, known.n) if known else bounded_broadcast(side, check=True), keys)
        sizes.append(F.col(f"__n{k}"))
    documents = documents.select(*doc, F.array(*sizes).alias("__sizes")).checkpoint()
    cells = cells.join(bounded_broadcast(documents, check=True), list(doc))
    flat = F.lit(0).cast("long")
    for k in range(len(dims)):
        flat = flat * F.get("__sizes", F.lit(k)) + F.col(f"__p{k}")
    return cells.withColumn("__flat", flat).checkpoint(), tables, documents


def encode_cubes(cells: DataFrame, doc: Sequence[str], dims: Sequence[CubeDim], header: dict[str, Column],
                 value: str = "value", status: str | None = "status") -> DataFrame:
    """Pieces of one JSON-stat document per distinct ``doc`` key: doc..., section, part, text.

    Pieces in the order of (section, part) are the document's text. ``cells``
    has a row per stored cell: the ``doc`` columns, each dimension's code
    column, ``value`` and ``status`` (null or ``''``: none); a code that its
    dimension's ``categories`` lack drops the cell, and two cells at one place
    are an error of the caller. ``header`` gives the texts ``label``,
    ``updated`` and ``datasetId`` as expressions of the ``doc`` columns.
    """
    placed, tables, documents = _placed(cells, doc, dims)
    keys = list(doc)

    def numbers(entry: Column, present: Column) -> DataFrame:
        chunk = F.floor(F.col("__flat") / CELLS_A_PIECE)
        return (placed.where(present).groupBy(*keys, chunk.alias("part"))
                .agg(_body(F.array_sort(F.collect_list(F.struct(F.col("__flat").alias("key"), entry.alias("value")))))
                     .alias("text")))

    # Bodies are bounded groups: at most CELLS_A_PIECE places fall into one.
    values = numbers(F.col(value).cast("double"), F.lit(True))
    pieces = [_joined(values, keys, VALUES)]
    if status is not None:
        pieces.append(_joined(numbers(F.col(status), F.coalesce(F.col(status), F.lit("")) != ""), keys, STATUSES))
    # What opens and closes each section, per document.
    json = {k: F.to_json(F.array(v.cast("string"))) for k, v in header.items()}
    json = {k: F.coalesce(F.substring(v, F.lit(2), F.length(v) - 2), F.lit('""')) for k, v in json.items()}
    names = ",".join(f'"{d.name}"' for d in dims)
    frame = [(HEAD, -1, F.concat(
                 F.lit('{"label":'), json["label"], F.lit(',"updated":'), json["updated"], F.lit(f',"id":[{names}],"size":'),
                 F.to_json("__sizes"), F.lit(',"extension":{"datasetId":'), json["datasetId"], F.lit('},"dimension":{'))),
             (VALUES, -1, F.lit('},"value":{')), (STATUSES, -1, F.lit('},"status":{')), (TAIL, -1, F.lit("}}"))]
    pieces.append(documents.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(p).cast("long").alias("part"), t.alias("text")) for s, p, t in frame])).alias("f"))
        .select(*keys, "f.*"))
    for k, (dim, (table, extent)) in enumerate(zip(dims, tables)):
        pieces.append(_dimension(documents, keys, k, dim, table, extent))
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out


def _joined(parts: DataFrame, keys: list[str], section: int) -> DataFrame:
    """Parts of one object: all but a document's first begin with a comma."""
    first = parts.groupBy(*keys).agg(F.min("part").alias("__first"))
    out = parts.join(first, keys)
    comma = F.when(F.col("part") > F.col("__first"), F.lit(",")).otherwise(F.lit(""))
    return out.select(*keys, F.lit(section).alias("section"), F.col("part").cast("long").alias("part"),
                      F.concat(comma, "text").alias("text"))


#: Part numbers of one dimension: its opening, index, labels and close lie in this span.
_SPAN = 1 << 40


def _dimension(documents: DataFrame, keys: list[str], k: int, dim: CubeDim, table: DataFrame, extent: Row | None) -> DataFrame:
    """The pieces of one dimension in every document."""
    own = [c for c in keys if c in table.columns]
    base, half = 2 * k * _SPAN, _SPAN

    def listed(entry: str, present: Column, offset: int, first_pos: int | None) -> DataFrame:
        chunk = F.floor(F.col("pos") / CATEGORIES_A_PIECE)
        body = _body(F.transform(
            F.array_sort(F.collect_list(F.struct("pos", F.col("code").alias("key"), F.col(entry).alias("value")))),
            lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value"))))
        parts = table.where(present).groupBy(*own, chunk.alias("part")).agg(body.alias("text"))
        if own:
            first = parts.groupBy(*own).agg(F.min("part").alias("__first"))
            parts = parts.join(first, own)
        else:
            # A label may be missing from the first chunk; the least of the chunks has no comma.
            parts = parts.withColumn("__first", F.lit((first_pos or 0) // CATEGORIES_A_PIECE))
        comma = F.when(F.col("part") > F.col("__first"), F.lit(",")).otherwise(F.lit(""))
        return parts.select(*own, (F.col("part").cast("long") + offset).alias("part"), F.concat(comma, "text").alias("text"))

    lists = listed("pos", F.lit(True), base, extent and extent.first).unionByName(
        listed("label", F.col("label").isNotNull(), base + half, extent and extent.labelled))
    fixed = documents.select(*keys, F.explode(F.array(
        F.struct(F.lit(base - 1).cast("long").alias("part"),
                 F.lit((',' if k else '') + f'"{dim.name}":{{"category":{{"index":{{').alias("text")),
        F.struct(F.lit(base + half - 1).cast("long").alias("part"), F.lit('},"label":{').alias("text")),
        F.struct(F.lit(base + 2 * half - 2).cast("long").alias("part"), F.lit("}}}").alias("text")))).alias("f")).select(*keys, "f.*")
    if own:
        lists = documents.select(*keys).join(lists, own)
    else:
        # Every document repeats the shared pieces: one row per document and part number, matched by that.
        last = (extent.last or 0) // CATEGORIES_A_PIECE
        numbers = F.concat(*[F.sequence(F.lit(base + at).cast("long"), F.lit(base + at + last).cast("long")) for at in (0, half)])
        lists = documents.select(*keys, F.explode(numbers).alias("part")).join(lists, "part")
    return fixed.unionByName(lists.select(*keys, "part", "text")).withColumn("section", F.lit(DIMENSIONS)).select(
        *keys, "section", "part", "text")


def document_rows(pieces: DataFrame, doc: Sequence[str]) -> DataFrame:
    """doc..., json: whole documents as rows, for documents known to be small."""
    parts = F.array_sort(F.collect_list(F.struct("section", "part", "text")))
    return pieces.groupBy(*doc).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("json"))


def write_documents(pieces: DataFrame, path: str, doc: str) -> None:
    """One file per document, ``<path>/<doc>=<value>/part-*.txt``: its pieces in
    order, a line each (pieces end between JSON tokens). A task streams a
    document to its file, however long it is."""
    out = pieces.select(F.col(doc), "section", "part", "text").repartition(doc).sortWithinPartitions(doc, "section", "part")
    out.select(doc, "text").write.mode("overwrite").partitionBy(doc).text(path)
