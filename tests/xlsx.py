"""Write minimal .xlsx workbooks (inline-string and number cells) for tests."""

from __future__ import annotations

import datetime as dt
import zipfile
from xml.sax.saxutils import escape


def _ref(row: int, col: int) -> str:
    letters = ""
    n = col + 1
    while n:
        n, r = divmod(n - 1, 26)
        letters = chr(65 + r) + letters
    return f"{letters}{row + 1}"


def _sheet_xml(cells: dict[tuple[int, int], object]) -> str:
    rows: dict[int, list[str]] = {}
    for (r, c), v in sorted(cells.items()):
        if v is None:
            continue
        if isinstance(v, dt.date):
            serial = (dt.datetime(v.year, v.month, v.day) - dt.datetime(1899, 12, 30)).days
            xml = f'<c r="{_ref(r, c)}" s="1"><v>{serial}</v></c>'
        elif isinstance(v, (int, float)) and not isinstance(v, bool):
            xml = f'<c r="{_ref(r, c)}"><v>{v}</v></c>'
        else:
            xml = f'<c r="{_ref(r, c)}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'
        rows.setdefault(r, []).append(xml)
    body = "".join(f'<row r="{r + 1}">{"".join(cs)}</row>' for r, cs in sorted(rows.items()))
    return ('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/'
            f'spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')


def write_xlsx(path: str, sheets: list[tuple[str, dict[tuple[int, int], object]]]) -> None:
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet_list = "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>'
                         for i, (n, _c) in enumerate(sheets))
    rels = "".join(f'<Relationship Id="rId{i + 1}" Type="{rel}/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                   for i in range(len(sheets)))
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/'
                    'package/2006/content-types"/>')
        zf.writestr("xl/styles.xml", f'<?xml version="1.0"?><styleSheet xmlns="{main}"><cellXfs count="2">'
                    '<xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        zf.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{rel}">'
                    f"<sheets>{sheet_list}</sheets></workbook>")
        zf.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.'
                    f'openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for i, (_n, cells) in enumerate(sheets):
            zf.writestr(f"xl/worksheets/sheet{i + 1}.xml", _sheet_xml(cells))


def trade_sheet(product: str, indicator: str, partners: list[str],
                rows: list[tuple[str, str, list[object]]]) -> dict[tuple[int, int], object]:
    """A matrix tab: metadata rows 4-7, header row 9, units row 10, data from 11."""
    cells: dict[tuple[int, int], object] = {
        (0, 0): "Dataset", (4, 0): "FREQ", (4, 2): "Monthly", (5, 0): "PRODUCT", (5, 2): product,
        (6, 0): "FLOW", (6, 2): "IMPORT", (7, 0): "INDICATORS", (7, 2): indicator,
        (9, 0): "REPORTER/PERIOD",
    }
    for j, p in enumerate(partners):
        cells[(9, 2 + j)] = p
        cells[(10, 2 + j)] = "units"
    cells[(10, 0)] = "units"
    for i, (country, month, values) in enumerate(rows):
        cells[(11 + i, 0)] = country
        cells[(11 + i, 1)] = month
        for j, v in enumerate(values):
            cells[(11 + i, 2 + j)] = v
    return cells
