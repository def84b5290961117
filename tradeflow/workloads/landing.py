"""Files that the job workloads read: workbooks and response documents made
from the star tables, written by tasks into a landing folder."""

from __future__ import annotations

import itertools
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import locate

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _letters(col: int) -> str:
    out, n = "", col + 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _write_book(out, cells: Iterator[tuple[int, str, int, int, str]]) -> None:
    """A workbook of inline texts; ``cells`` (sheet_ord, sheet, row, col, text) in that order."""
    titles = []
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for (_, title), tab in itertools.groupby(cells, key=lambda c: c[:2]):
            titles.append(title)
            with zf.open(f"xl/worksheets/sheet{len(titles)}.xml", "w") as part:
                part.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                for row, own in itertools.groupby(tab, key=lambda c: c[2]):
                    body = "".join(f'<c r="{_letters(c)}{row + 1}" t="inlineStr"><is><t>{escape(t)}</t></is></c>'
                                   for _, _, _, c, t in own)
                    part.write(f'<row r="{row + 1}">{body}</row>'.encode())
                part.write(b"</sheetData></worksheet>")
        sheets = "".join(f'<sheet name={quoteattr(t)} sheetId="{k}" r:id="r{k}"/>' for k, t in enumerate(titles, 1))
        rels = "".join(f'<Relationship Id="r{k}" Type="{_REL}/worksheet" Target="worksheets/sheet{k}.xml"/>'
                       for k in range(1, len(titles) + 1))
        zf.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{sheets}</sheets></workbook>')
        zf.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}">{rels}</Relationships>')


def _open(path: str):
    fs, at = locate(path)
    fs.create_dir(at.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(at)


def write_books(cells: DataFrame, folder: str) -> None:
    """One workbook per ``source_name`` (a path below ``folder``): cells
    ``sheet_ord, sheet, row, col, text``. A task streams a book's cells to its file."""
    columns = ["source_name", "sheet_ord", "sheet", "row", "col", "text"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        for name, book in itertools.groupby(rows, key=lambda r: r[0]):
            with _open(f"{folder}/{name}") as out:
                _write_book(out, (r[1:] for r in book))
            yield pa.RecordBatch.from_pydict({"path": [name]})

    dealt = (cells.select(*columns).where(F.col("text").isNotNull()).repartition("source_name")
             .sortWithinPartitions("source_name", "sheet_ord", "row", "col"))
    dealt.mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()


def write_texts(texts: DataFrame, folder: str) -> None:
    """One file per row: ``path`` below ``folder`` and ``text``."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, text in zip(*[c.to_pylist() for c in b.columns]):
                with _open(f"{folder}/{path}") as out:
                    out.write(text.encode())
            yield b.select(["path"])

    texts.select("path", "text").mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
