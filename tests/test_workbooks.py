"""Workbooks read in ranges: the same cells in any cut, bounded memory, a data source."""

from __future__ import annotations

import io
import os
import subprocess
import sys
import tempfile
import textwrap
import zipfile
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tradeflow.sources import workbooks as wb
from xlsx import write_xlsx

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _zip(parts: dict[str, str | bytes], titles=("Sheet 1",)) -> zipfile.ZipFile:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as zf:
        sheets = "".join(f'<sheet name="{t}" sheetId="{k + 1}" r:id="r{k + 1}"/>' for k, t in enumerate(titles))
        zf.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{sheets}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="r{k + 1}" Target="worksheets/s{k + 1}.xml"/>' for k in range(len(titles)))
        zf.writestr("xl/_rels/workbook.xml.rels",
                    f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for name, text in parts.items():
            zf.writestr(name, text)
    return zipfile.ZipFile(buffer)


def _row(n: int, extra: str = "") -> str:
    return (f'<row r="{n}"{extra}><c r="A{n}" t="s"><v>{n % 7}</v></c><c r="B{n}"><v>{n}.5</v></c>'
            f'<c r="C{n}" t="inlineStr"><is><t>&lt;row r="9"&gt; é {n}</t></is></c></row>')


def _sheet(rows: int, prefix: str = "") -> str:
    body = "".join(_row(n, ' x:h="1"') for n in range(1, rows + 1))
    if prefix:
        body = body.replace("</", f"</{prefix}:").replace("<", f"<{prefix}:").replace(f"<{prefix}:/{prefix}:", f"</{prefix}:")
    p = f"{prefix}:" if prefix else ""
    name = f"xmlns:{prefix}" if prefix else "xmlns"
    return (f'<?xml version="1.0"?><{p}worksheet {name}="{MAIN}" xmlns:x="urn:x"><{p}cols/><{p}sheetData>{body}</{p}sheetData>'
            f'<{p}rowBreaks count="1"><{p}brk id="3"/></{p}rowBreaks></{p}worksheet>')


STRINGS = f'<sst xmlns="{MAIN}">' + "".join(f"<si><t>s{k}</t></si>" for k in range(7)) + "</sst>"


def _cells(zf, size):
    tabs, date1904 = wb.workbook_tabs(zf)
    return [c for tab in tabs for start, stop in wb.tab_ranges(tab, size) for c in wb.tab_cells(zf, tab, start, stop, date1904)]


@pytest.mark.parametrize("prefix", ["", "m"])
@pytest.mark.parametrize("size,step", [(1 << 26, 1 << 18), (997, 64), (311, 1000), (50, 7), (3, 1)])
def test_any_cut_gives_the_same_cells(monkeypatch, size, step, prefix):
    monkeypatch.setattr(wb, "STEP_BYTES", step)
    rows = 40 if size > 3 else 6
    zf = _zip({"xl/worksheets/s1.xml": _sheet(rows, prefix), "xl/sharedStrings.xml": STRINGS})
    expected = [(0, "Sheet 1", n - 1, c, t, None, None) for n in range(1, rows + 1)
                for c, t in enumerate((f"s{n % 7}", f"{n}.5", f'<row r="9"> é {n}'))]
    assert _cells(zf, size) == expected
    monkeypatch.setattr(wb, "SHARED_BYTES", 0)  # only the strings that a range names are held
    assert _cells(zf, size) == expected


@pytest.mark.parametrize("size", [1 << 26, 60])
def test_tabs_without_rows_in_other_encodings_or_broken(size):
    good = _sheet(3)
    parts = {"xl/sharedStrings.xml": STRINGS,
             "xl/worksheets/s1.xml": f'<worksheet xmlns="{MAIN}"/>',
             "xl/worksheets/s2.xml": f'<worksheet xmlns="{MAIN}"><sheetData/></worksheet>',
             "xl/worksheets/s3.xml": f'<worksheet xmlns="{MAIN}"><sheetData></sheetData></worksheet>',
             "xl/worksheets/s4.xml": good.replace('version="1.0"', 'version="1.0" encoding="UTF-16"').encode("utf-16"),
             "xl/worksheets/s5.xml": good[:good.index("</sheetData>") - 20],
             "xl/worksheets/s6.xml": "no xml",
             "xl/worksheets/s7.xml": good.replace("<v>2</v>", "<v>99</v>")}
    zf = _zip(parts, [f"T{k}" for k in range(1, 9)])  # the eighth has no part
    found = _cells(zf, size)
    assert [c[2] for c in found if c[1] == "T4" and c[3] == 0] == [0, 1, 2]
    broken = {c[1] for c in found if c[6]}
    assert broken == {"T5", "T6", "T7", "T8"}
    assert not [c for c in found if c[1] in ("T1", "T2", "T3")]


def test_a_damaged_part_is_told_in_every_cut():
    data = bytearray()
    zf = _zip({"xl/worksheets/s1.xml": _sheet(200), "xl/sharedStrings.xml": STRINGS})
    data += zf.fp.getvalue()
    info = zf.getinfo("xl/worksheets/s1.xml")
    data[info.header_offset + len(info.filename) + 30 + info.compress_size // 2] ^= 0xFF
    damaged = zipfile.ZipFile(io.BytesIO(bytes(data)))
    for size in (1 << 26, 2000):
        assert any(c[6] for c in _cells(damaged, size))


def _folder():
    folder = tempfile.mkdtemp(prefix="tf-book-")
    for k in range(3):
        write_xlsx(f"{folder}/b{k}.xlsx", [(f"Sheet {t}", {(r, c): f"{k}{t}{r}{c}" for r in range(60) for c in range(4)})
                                           for t in range(2)] + [("Notes", {(0, 0): "n"})])
    with open(f"{folder}/bad.xlsx", "wb") as fh:
        fh.write(b"no zip")
    return folder


def test_scan_in_ranges_and_the_data_source_agree(spark):
    folder = _folder()
    whole = wb.scan_workbooks(spark, folder).checkpoint()
    assert whole.where("error IS NULL").count() == 3 * (2 * 240 + 1) and whole.where("error IS NOT NULL").count() == 1
    columns = [c for c in whole.columns if c != "error"]

    def rows(df):
        return sorted(tuple(str(v) for v in r) for r in df.select(*columns).collect())
    assert rows(wb.scan_workbooks(spark, folder, range_bytes=500)) == rows(whole)
    wb.register_workbook_source(spark)
    source = spark.read.format("workbook_cells").option("path", folder).option("rangeBytes", "700").load()
    assert source.rdd.getNumPartitions() > 20
    assert rows(source) == rows(whole)
    prefixed = wb.scan_workbooks(spark, folder, sheet_prefix="Notes").where("error IS NULL")
    assert sorted(r.text for r in prefixed.collect()) == ["n"] * 3


def test_filters_reach_the_data_source(spark):
    folder = _folder()
    wb.register_workbook_source(spark)
    source = spark.read.format("workbook_cells").option("path", folder).load()
    one = source.where(F.col("sheet").startswith("Sheet") & (F.col("source_name") == "b1.xlsx"))
    assert one.count() == 480 and one.rdd.getNumPartitions() == 2  # two tabs of one file
    assert source.where(F.col("sheet").isin("Notes", "none")).count() == 3


def test_a_tab_of_200_mb_stays_under_a_memory_bound():
    """A process of its own reads a tab of 200 MB of XML whole; then one range of it."""
    folder = tempfile.mkdtemp(prefix="tf-big-")
    cells = "".join(f'<c r="{chr(65 + c)}%d" t="s"><v>%d</v></c>' for c in range(20))
    with zipfile.ZipFile(f"{folder}/big.xlsx", "w", zipfile.ZIP_DEFLATED, compresslevel=1) as zf:
        with _zip({}) as small:
            for name in small.namelist():
                zf.writestr(name, small.read(name))
        with zf.open("xl/worksheets/s1.xml", "w") as out:
            out.write(f'<worksheet xmlns="{MAIN}"><sheetData>'.encode())
            n = written = 0
            while written < 200 << 20:
                n += 1
                row = f'<row r="{n}">{cells % tuple(x for c in range(20) for x in (n, (n * 20 + c) % 300_000))}</row>'.encode()
                written += out.write(row)
            out.write(b"</sheetData></worksheet>")
        with zf.open("xl/sharedStrings.xml", "w") as out:
            out.write(f'<sst xmlns="{MAIN}">'.encode())
            for k in range(300_000):
                out.write(f"<si><t>{'a shared string of some length ' * 3}{k}</t></si>".encode())
            out.write(b"</sst>")
    code = textwrap.dedent(f"""
        import resource, sys, zipfile
        sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
        from tradeflow.sources import workbooks as wb
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        zf = zipfile.ZipFile({folder!r} + "/big.xlsx")
        tab = wb.workbook_tabs(zf)[0][0]
        ranges = wb.tab_ranges(tab)
        n = sum(c[6] is None for c in wb.tab_cells(zf, tab, *ranges[1]))
        print(len(ranges), n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024, tab.size >> 20)
    """)
    ranges, n, grown, size = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                                                     check=True).stdout.split())
    assert ranges == 4 and size >= 200 and n > 1_000_000
    assert grown < 150, f"{grown} MB for one range of {size} MB"


def test_the_scan_needs_no_package_on_the_workers(spark):
    """What is sent to the workers names no module of this package."""
    import pickletools

    from pyspark import cloudpickle
    named = [arg for op, arg, _ in pickletools.genops(cloudpickle.dumps((wb._plan, wb._read, wb.WorkbookSource)))
             if isinstance(arg, str) and arg.startswith("tradeflow") and " " in arg]
    assert named == []
    code = textwrap.dedent("""
        import pickle, sys
        functions = pickle.loads(sys.stdin.buffer.read())
        assert not any(m.startswith("tradeflow") for m in sys.modules)
        print(functions[0]("n", "file:///nowhere.xlsx", None, "", 100)[0][-1].split(":")[0])
    """)
    out = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps((wb._plan,)), capture_output=True,
                         cwd=tempfile.mkdtemp(), env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.stdout.decode().strip() == "FileNotFoundError", out.stderr.decode()[-2000:]


def test_paths_as_spark_writes_them(monkeypatch):
    from tradeflow.sources import files
    seen = []
    stub = SimpleNamespace(LocalFileSystem=lambda: None,
                           FileSystem=SimpleNamespace(from_uri=lambda uri: seen.append(uri) or (None, uri)))
    monkeypatch.setattr(files, "pafs", stub)
    for uri in ("s3a://bucket/a b", "s3://bucket/x", "hdfs://host/x"):
        files.locate(uri)
    assert seen == ["s3://bucket/a b", "s3://bucket/x", "hdfs://host/x"]
    assert files.locate("file:///tmp/x")[1] == files.locate("/tmp/x")[1] == "/tmp/x"
