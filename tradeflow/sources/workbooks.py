"""Spreadsheet (.xlsx) scan: file listing and workbook cells.

The cell grid is read with the standard library (an .xlsx file is a zip of
XML parts); formulas and charts are ignored, styles only to tell dates from
numbers. A tab is read as a stream, in ranges of its XML: a task opens the
workbook, inflates one tab and parses the rows that begin in its range, so it
holds neither the file nor the tab. A date-formatted numeric cell comes out as
ISO text with ``kind = 'date'``.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from array import array
from collections.abc import Iterator, Sequence
from typing import BinaryIO, NamedTuple
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from .files import folder_files, open_file

CELLS_SCHEMA = ("source_name string, source_path string, source_mtime timestamp, sheet_ord int, sheet string, "
                "row int, col int, text string, kind string, error string")
LISTING_COLUMNS = ["source_path", "source_name", "size_bytes", "mtime", "fingerprint"]

_NS = {
    "m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "rel": "http://schemas.openxmlformats.org/package/2006/relationships",
}
_REF = re.compile(r"([A-Z]+)(\d+)")
# Built-in number formats that display dates.
DATE_FORMAT_IDS = frozenset(range(14, 23)) | {45, 46, 47}
_QUOTED = re.compile(r'"[^"]*"|\[[^\]]*\]|\\.')
# Texts that stand for a missing value, like an empty cell.
MISSING_TEXTS = frozenset({
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null"})
# Cells that a task hands on at once.
CELLS_PER_BATCH = 50_000
# Inflated bytes of a tab's XML that one task parses.
RANGE_BYTES = 64 << 20
# Bytes inflated or parsed at once.
STEP_BYTES = 1 << 18
# Shared strings up to this size are held whole; of larger ones only those that
# the task's rows name.
SHARED_BYTES = 16 << 20


def list_sources(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """Source files right under ``path`` with size, mtime and a size+mtime
    fingerprint. Lock files (``~$...``) are skipped. One driver row per file:
    names and sizes, as any file listing holds them."""
    rows = [(uri, name, size, mtime, f"{size}-{int(mtime.timestamp() * 1_000_000)}")
            for uri, name, size, mtime in folder_files(path, glob) if not name.startswith("~$")]
    return spark.createDataFrame(rows, "source_path string, source_name string, size_bytes long, mtime timestamp, "
                                       "fingerprint string")


def first_available_source(spark: SparkSession, candidates: Sequence[str], glob: str = "*.xlsx") -> str:
    """First candidate folder holding at least one source file. A folder that
    exists but cannot be read is an error, not a missing candidate."""
    for candidate in candidates:
        try:
            if any(not name.startswith("~$") for _, name, *_ in folder_files(candidate, glob)):
                return candidate
        except FileNotFoundError:
            continue
    raise FileNotFoundError(f"No source directory found. Checked: {', '.join(candidates)}")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text_of(node) -> str:
    """Text of a string item: its own ``t`` or its rich-text runs' ``t``;
    phonetic runs (``rPh``) are not part of the value."""
    t_tag, r_tag = f"{{{_NS['m']}}}t", f"{{{_NS['m']}}}r"
    parts = []
    for child in node:
        if child.tag == t_tag:
            parts.append(child.text or "")
        elif child.tag == r_tag:
            parts.extend(t.text or "" for t in child.findall("m:t", _NS))
    return "".join(parts)


def _date_styles(zf: zipfile.ZipFile, names: set[str]) -> set[int]:
    """Indexes of cell styles whose number format shows a date."""
    if "xl/styles.xml" not in names:
        return set()
    root = ET.fromstring(zf.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")): f.get("formatCode", "")
              for f in root.findall("m:numFmts/m:numFmt", _NS)}
    dates = set()
    for i, xf in enumerate(root.findall("m:cellXfs/m:xf", _NS)):
        fmt = int(xf.get("numFmtId", "0"))
        code = _QUOTED.sub("", custom.get(fmt, "")).lower()
        if fmt in DATE_FORMAT_IDS or (fmt in custom and re.search(r"[dy]", code)):
            dates.add(i)
    return dates


def _serial_to_iso(serial: str, date1904: bool) -> str:
    base = dt.datetime(1904, 1, 1) if date1904 else dt.datetime(1899, 12, 30)
    value = base + dt.timedelta(days=float(serial))
    return value.strftime("%Y-%m-%d") if value.time() == dt.time() else value.strftime("%Y-%m-%d %H:%M:%S")


class Tab(NamedTuple):
    """A tab of a workbook and the part of the zip that holds its rows."""
    ordinal: int
    title: str
    part: str | None
    size: int  # of the part, inflated


def _zip(source: pa.NativeFile) -> zipfile.ZipFile:
    if source.size() < 22:  # less than a zip's directory: seeking it would be an error of another kind
        raise zipfile.BadZipFile("File is not a zip file")
    return zipfile.ZipFile(source)


def _relations(zf: zipfile.ZipFile) -> dict[str, str]:
    if "xl/_rels/workbook.xml.rels" not in zf.namelist():
        return {}
    found = {}
    for rel in ET.fromstring(zf.read("xl/_rels/workbook.xml.rels")).findall("rel:Relationship", _NS):
        target = rel.get("Target", "")
        found[rel.get("Id")] = target.lstrip("/") if target.startswith("/") else "xl/" + target
    return found


def workbook_tabs(zf: zipfile.ZipFile) -> tuple[list[Tab], bool]:
    """The tabs in order, and whether dates count from 1904."""
    wb, rels, names = ET.fromstring(zf.read("xl/workbook.xml")), _relations(zf), set(zf.namelist())
    pr = wb.find("m:workbookPr", _NS)
    tabs = []
    for ordinal, sheet in enumerate(wb.findall("m:sheets/m:sheet", _NS)):
        part = rels.get(sheet.get(f"{{{_NS['r']}}}id"))
        tabs.append(Tab(ordinal, sheet.get("name"), part, zf.getinfo(part).file_size if part in names else 0))
    return tabs, pr is not None and pr.get("date1904") in ("1", "true")


class _Rows:
    """The row elements of a tab that begin in a range of its inflated bytes.

    What stands before the rows is always parsed (it declares the namespaces),
    what lies between there and the range is only inflated. The open last range
    reads on to the end of the part, where its checksum is tested.
    """

    def __init__(self, source: BinaryIO, start: int, stop: int | None):
        self.source, self.start, self.stop = source, start, stop
        self.held, self.at = b"", 0  # bytes in hand, and the offset of the first

    def _more(self) -> bool:
        step = self.source.read(STEP_BYTES)
        self.held += step
        return bool(step)

    def _drop(self, n: int) -> None:
        n = max(0, n)
        self.held, self.at = self.held[n:], self.at + n

    def _to_the_end(self) -> None:
        while self.source.read(STEP_BYTES):
            pass

    def __iter__(self) -> Iterator[ET.Element]:
        row, rows = f"{{{_NS['m']}}}row", f"{{{_NS['m']}}}sheetData"
        while not (opened := re.search(rb"<((?:[\w.-]+:)?)sheetData(?=[\s/>])[^>]*>", self.held)):
            if not self._more():
                if self.start == 0:  # no rows, an encoding that cannot be cut, or broken: the parser tells
                    yield from ET.fromstring(self.held).iter(row)
                return
        if opened[0].endswith(b"/>"):
            return self._to_the_end()
        parser, parent = ET.XMLPullParser(["start", "end"]), None
        parser.feed(self.held[:opened.end()])
        self._drop(opened.end())
        row_tag, end_tag = re.compile(rb"<" + opened[1] + rb"row(?=[\s/>])"), b"</" + opened[1] + b"sheetData"
        tail = len(end_tag)  # a tag may lie across two steps

        # The first row that begins at the start of the range or after it.
        while self.at < self.start:
            self._drop(min(len(self.held), self.start - self.at))
            if self.at < self.start and not self._more():
                return
        while not (first := row_tag.search(self.held)):
            over = self.held.find(end_tag)
            if over >= 0:
                return self._to_the_end()
            self._drop(len(self.held) - tail)
            if not self._more():
                if self.start == 0:
                    raise ET.ParseError("the rows have no end")
                return  # beyond the rows
        over = self.held.find(end_tag)
        if 0 <= over < first.start() or (self.stop is not None and self.at + first.start() >= self.stop):
            return self._to_the_end() if self.stop is None else None
        self._drop(first.start())

        while True:
            over = self.held.find(end_tag)
            beyond = None if self.stop is None else row_tag.search(self.held, max(0, self.stop - self.at))
            ends = ([over] if over >= 0 else []) + ([beyond.start()] if beyond else [])
            cut = min(ends) if ends else max(0, len(self.held) - tail)
            parser.feed(self.held[:cut])
            self._drop(cut)
            if ends and hasattr(parser, "flush"):
                parser.flush()  # newer parsers put off what may be part of a token
            for event, element in parser.read_events():
                if event == "start" and element.tag == rows:
                    parent = element
                elif event == "end" and element.tag == row:
                    yield element
                    element.clear()
            if parent is not None:
                del parent[:-1]  # rows that were read; the last may be open
            if ends:
                return self._to_the_end() if self.stop is None else None
            if not self._more():
                raise ET.ParseError("the rows have no end")


class _Strings:
    """Shared strings: one buffer and offsets, no object per string."""

    def __init__(self, zf: zipfile.ZipFile, wanted: set[int] | None):
        self.offsets, self.buffer, self.place = array("Q", [0]), bytearray(), None if wanted is None else {}
        if "xl/sharedStrings.xml" not in zf.namelist():
            return
        item, n = f"{{{_NS['m']}}}si", 0
        with zf.open("xl/sharedStrings.xml") as source:
            events = ET.iterparse(source, ["start", "end"])
            _, root = next(events)
            for event, element in events:
                if event != "end" or element.tag != item:
                    continue
                if wanted is None or n in wanted:
                    if self.place is not None:
                        self.place[n] = len(self.offsets) - 1
                    self.buffer += _text_of(element).encode()
                    self.offsets.append(len(self.buffer))
                n += 1
                root.clear()

    def __getitem__(self, k: int) -> str:
        k = k if self.place is None else self.place[k]
        if not 0 <= k < len(self.offsets) - 1:
            raise IndexError(f"no shared string {k}")
        return self.buffer[self.offsets[k]:self.offsets[k + 1]].decode()


def _shared_wanted(zf: zipfile.ZipFile, tab: Tab, start: int, stop: int | None) -> set[int] | None:
    """Which shared strings a range names; None if all of them are small enough to hold."""
    if "xl/sharedStrings.xml" not in zf.namelist() or zf.getinfo("xl/sharedStrings.xml").file_size <= SHARED_BYTES:
        return None
    wanted = set()
    with zf.open(tab.part) as source:
        for row in _Rows(source, start, stop):
            for c in row.iter(f"{{{_NS['m']}}}c"):
                v = c.find("m:v", _NS)
                if c.get("t") == "s" and v is not None and v.text:
                    wanted.add(int(v.text))
    return wanted


def tab_cells(zf: zipfile.ZipFile, tab: Tab, start: int = 0, stop: int | None = None, date1904: bool = False
              ) -> Iterator[tuple]:
    """(sheet_ord, sheet, row, col, text, kind, error) for each non-empty cell of
    the rows of a tab that begin in the range of its inflated bytes; one error
    row if the tab or this part of it cannot be read."""
    try:
        if tab.part is None:
            raise KeyError(f"the workbook names no part for {tab.title}")
        date_styles = _date_styles(zf, set(zf.namelist()))
        shared = _Strings(zf, _shared_wanted(zf, tab, start, stop))
        with zf.open(tab.part) as source:
            for row in _Rows(source, start, stop):
                for c in row.iter(f"{{{_NS['m']}}}c"):
                    m = _REF.match(c.get("r", ""))
                    if not m:
                        continue
                    kind, cell_kind = c.get("t", "n"), None
                    if kind == "inlineStr":
                        is_node = c.find("m:is", _NS)
                        text = _text_of(is_node) if is_node is not None else None
                    else:
                        v = c.find("m:v", _NS)
                        text = v.text if v is not None else None
                        if text is not None and kind == "s":
                            text = shared[int(text)]
                        elif text is not None and kind == "b":
                            text = "True" if text == "1" else "False"
                        elif text is not None and kind == "n" and int(c.get("s", "0")) in date_styles:
                            text, cell_kind = _serial_to_iso(text, date1904), "date"
                    if text is None or text == "" or text in MISSING_TEXTS:
                        continue
                    yield tab.ordinal, tab.title, int(m.group(2)) - 1, _col_index(m.group(1)), text, cell_kind, None
    except Exception as exc:  # noqa: BLE001 - a broken tab is reported, the others are read
        yield tab.ordinal, tab.title, None, None, None, None, f"{type(exc).__name__}: {exc}"


def tab_ranges(tab: Tab, size: int = RANGE_BYTES) -> list[tuple[int, int | None]]:
    """Ranges of a tab's inflated bytes, the last one open to its end."""
    starts = list(range(0, max(1, tab.size), size))
    return list(zip(starts, [*starts[1:], None]))


def workbook_cells(content: bytes) -> Iterator[tuple]:
    """(sheet_ord, sheet, row, col, text, kind, error) for each non-empty cell of a workbook."""
    zf = zipfile.ZipFile(io.BytesIO(content))
    tabs, date1904 = workbook_tabs(zf)
    for tab in tabs:
        yield from tab_cells(zf, tab, date1904=date1904)


_RANGES = pa.schema([("source_name", pa.string()), ("source_path", pa.string()), ("source_mtime", pa.timestamp("us", "UTC")),
                     ("ordinal", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("error", pa.string())])
_CELLS = pa.schema([("source_name", pa.string()), ("source_path", pa.string()), ("source_mtime", pa.timestamp("us", "UTC")),
                    ("sheet_ord", pa.int32()), ("sheet", pa.string()), ("row", pa.int32()), ("col", pa.int32()),
                    ("text", pa.string()), ("kind", pa.string()), ("error", pa.string())])


def _plan(name: str, path: str, mtime, prefix: str, size: int) -> list[tuple]:
    """The ranges of one workbook, or one row with its error."""
    try:
        with open_file(path) as source:
            tabs, _ = workbook_tabs(_zip(source))
    except Exception as exc:  # noqa: BLE001 - unreadable workbook -> one error row
        return [(name, path, mtime, None, None, None, f"{type(exc).__name__}: {exc}")]
    return [(name, path, mtime, tab.ordinal, start, stop, None) for tab in tabs if (tab.title or "").startswith(prefix)
            for start, stop in tab_ranges(tab, size)]


def _read(name: str, path: str, mtime, ordinal: int | None, start: int | None, stop: int | None, error: str | None
          ) -> Iterator[pa.RecordBatch]:
    """The cells of one planned range."""
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        head = [pa.array([v] * len(rows), t) for v, t in zip((name, path, mtime), _CELLS.types)]
        columns = zip(*rows) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays(head + [pa.array(c, t) for c, t in zip(columns, _CELLS.types[3:])], schema=_CELLS)

    if error is not None:
        yield batch([(None, None, None, None, None, None, error)])
        return
    rows: list[tuple] = []
    try:
        with open_file(path) as source:
            zf = _zip(source)
            tabs, date1904 = workbook_tabs(zf)
            for cell in tab_cells(zf, tabs[ordinal], start, stop, date1904):
                rows.append(cell)
                if len(rows) == CELLS_PER_BATCH:
                    yield batch(rows)
                    rows = []
    except Exception as exc:  # noqa: BLE001 - a file that went away meanwhile
        rows.append((None, None, None, None, None, None, f"{type(exc).__name__}: {exc}"))
    if rows:
        yield batch(rows)


def scan_workbooks(spark: SparkSession, sources: str | DataFrame, glob: str = "*.xlsx", sheet_prefix: str = "",
                   range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Cells of every workbook of a folder, or of a listing (``list_sources``).

    Two steps: tasks open the workbooks and name the ranges of their tabs, then
    a task reads each range, so a workbook of large tabs is many tasks.
    Lock files are skipped; of tabs only those are opened whose name begins with
    ``sheet_prefix``. A workbook or tab that cannot be read yields a row
    with ``error`` set (see :func:`workbook_errors`). Every use of the result
    parses the workbooks again: write or checkpoint it first.
    """
    files = list_sources(spark, sources, glob) if isinstance(sources, str) else sources
    files = files.select("source_name", "source_path", "mtime")

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, path, mtime in zip(*[c.to_pylist() for c in b.columns]):
                found = _plan(name, path, mtime, sheet_prefix, range_bytes)
                yield pa.RecordBatch.from_pylist([dict(zip(_RANGES.names, r)) for r in found], schema=_RANGES)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for planned in zip(*[c.to_pylist() for c in b.columns]):
                yield from _read(*planned)

    # A task per file and then per range, up to the session's shuffle partitions.
    ranges = files.repartition("source_path").mapInArrow(
        plan, "source_name string, source_path string, source_mtime timestamp, ordinal int, start long, stop long, error string")
    return ranges.repartition("source_path", "ordinal", "start").mapInArrow(read, CELLS_SCHEMA)


class WorkbookSource(DataSource):
    """``spark.read.format("workbook_cells").option("path", folder).load()``: the
    cells of :func:`scan_workbooks` as a data source of Spark, a partition per
    range. Filters on ``sheet`` and ``source_name`` reach it, so tabs and files
    that they exclude are not opened to read. Options: ``path``, ``glob``,
    ``rangeBytes``. Register it with :func:`register_workbook_source`.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook_cells"

    def schema(self) -> str:
        return CELLS_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _WorkbookReader(self.options["path"], self.options.get("glob", "*.xlsx"),
                               int(self.options.get("rangeBytes", RANGE_BYTES)))


class _WorkbookReader(DataSourceReader):
    def __init__(self, path: str, glob: str, size: int):
        self.path, self.glob, self.size = path, glob, size
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column in ("sheet", "source_name") and isinstance(f, (EqualTo, In, StringStartsWith)):
                kind = "prefix" if isinstance(f, StringStartsWith) else "value"
                self.tests.append((column, kind, tuple(f.value) if isinstance(f, In) else (f.value,)))
            yield f  # rows with an error have no sheet: Spark tests every row again

    def _passes(self, column: str, text: str) -> bool:
        return all(text in values if kind == "value" else text.startswith(values)
                   for c, kind, values in self.tests if c == column)

    def partitions(self) -> list[InputPartition]:
        planned = []
        for path, name, _, mtime in folder_files(self.path, self.glob):
            if name.startswith("~$") or not self._passes("source_name", name):
                continue
            try:
                with open_file(path) as source:
                    wanted = {t.ordinal for t in workbook_tabs(_zip(source))[0] if self._passes("sheet", t.title or "")}
            except Exception:  # noqa: BLE001 - _plan tells the error
                wanted = {None}
            planned += [InputPartition(r) for r in _plan(name, path, mtime, "", self.size) if r[3] in wanted or r[6]]
        return planned

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is not None and partition.value is not None:
            yield from _read(*partition.value)


def register_workbook_source(spark: SparkSession) -> None:
    """Make the format known to the session, and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WorkbookSource)


def workbook_errors(cells: DataFrame) -> DataFrame:
    """Unreadable workbooks and tabs."""
    return cells.where(F.col("error").isNotNull()).select("source_path", "sheet", "error")


def require_readable(cells: DataFrame) -> DataFrame:
    """``cells``, or an error that names every workbook and tab that cannot be read."""
    bad = [f"{r.source_path}{f' [{r.sheet}]' if r.sheet else ''}: {r.error}"
           for r in workbook_errors(cells).orderBy("source_path", "sheet").toLocalIterator()]
    if bad:
        raise ValueError(f"{len(bad)} workbooks or tabs cannot be read: {'; '.join(bad)}")
    return cells
