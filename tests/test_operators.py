"""Operators: the reference's own tests (parity) and edge cases."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tradeflow import dims
from tradeflow.jobs.stages import merged_rows
from tradeflow.operators import (align_pair, conform_tyre, enrich_partner, exclude_values, keep_latest,
                                 lookup_strict)
from tradeflow.operators.cube import (check_latest_periods, conform_cube, cube_columns, decode_cube,
                                      latest_period)
from tradeflow.operators.matrix import matrix_to_long
from tradeflow.sources.cubes import parse_cubes

TYRE_A = "New pneumatic tyres, of rubber, of a kind used for motor cars, incl. station wagons and racing cars"
FACT = "country string, date date, product string, partner string, hs_code string, category string, " \
       "general_category string"


def _partners(spark):
    return spark.createDataFrame([("China", "Asia", "Eastern Asia"), ("High seas", "Other", "Other")],
                                 "partner string, partner_continent string, partner_sub_region string")


def _empty(spark, measure, with_category=True):
    cat = " category string," if with_category else ""
    return spark.createDataFrame([], f"country string, date date, product string, partner string, "
                                     f"hs_code string,{cat} general_category string, {measure} double")


def test_tyre_merge_scales_weight_once(spark):
    d = dt.date(2024, 1, 1)
    v = spark.createDataFrame([("Malta", d, "some tyre", "Peru", "401120", "TBR", "TBR", 31.5)], FACT + ", value double")
    w = spark.createDataFrame([("Malta", d, "some tyre", "Peru", "401120", "TBR", "TBR", 4.0)], FACT + ", weight double")
    rows = merged_rows(v, w, _empty(spark, "value", False), _empty(spark, "weight", False), _partners(spark),
                       "2017-01-01").collect()
    assert len(rows) == 1 and rows[0].weight == 400.0 and rows[0].value == 31.5


def test_vehicle_merge_adds_empty_category(spark):
    d = dt.date(2024, 1, 1)
    schema = "country string, date date, product string, partner string, hs_code string, general_category string"
    v = spark.createDataFrame([("Cyprus", d, "some lorry", "Chile", "8704", "TBR", 55.0)], schema + ", value double")
    w = spark.createDataFrame([("Cyprus", d, "some lorry", "Chile", "8704", "TBR", 6.5)], schema + ", weight double")
    rows = merged_rows(_empty(spark, "value"), _empty(spark, "weight"), v, w, _partners(spark)).collect()
    assert len(rows) == 1
    assert rows[0].category is None and rows[0].weight == 650.0 and rows[0].type == "Vehicle"


def test_keep_latest_snapshot(spark):
    keys = ["country", "date", "product", "indicator", "partner", "hs_code", "category", "general_category"]
    base = ("Spain", "2024-01-01", "some tyre", "VALUE_IN_EUROS", "China", "401110", "PCR", "PCR")
    df = spark.createDataFrame([base + (10.0, "old.xlsx", 1), base + (20.0, "new.xlsx", 2)],
                               ", ".join(f"{k} string" for k in keys) + ", value double, src string, mtime long")
    out = keep_latest(df, keys, ["mtime", "src"]).collect()
    assert [r.value for r in out] == [20.0]


def test_keep_latest_ties(spark):
    df = spark.createDataFrame([("k", 1.0, "a.xlsx", 5, 0), ("k", 2.0, "b.xlsx", 5, 0),
                                ("j", 3.0, "a.xlsx", 1, 1), ("j", 4.0, "a.xlsx", 1, 0)],
                               "k string, v double, src string, mtime long, pos int")
    out = {r.k: r.v for r in keep_latest(df, ["k"], ["mtime", "src", "pos"]).collect()}
    assert out == {"k": 2.0, "j": 3.0}


def test_align_null_keys_and_sides(spark):
    v = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("b", 5.0), ("z", None)], "k string, value double")
    w = spark.createDataFrame([(None, 3.0), ("a", None), ("c", 1.0), ("z", 4.0)], "k string, weight double")
    out = {r.k: (r.value, r.weight) for r in align_pair(v, w, ["k"]).collect()}
    assert out == {None: (1.0, 3.0), "a": (2.0, 0.0), "z": (0.0, 4.0)}


def test_lookup_strict_lists_unmapped(spark):
    df = spark.createDataFrame([("p2",), ("p1",), (None,), ("ok",)], "product string")
    dim = spark.createDataFrame([("ok", "1")], "product string, hs_code string")
    with pytest.raises(ValueError, match=r"ctx: product -> hs_code: p1, p2$"):
        lookup_strict(df, dim, "product", ["hs_code"], "ctx")


def test_partner_defaults(spark):
    df = spark.createDataFrame([("Atlantis",), ("High seas",), ("China",)], "partner string")
    out = {r.partner: r.partner_continent for r in enrich_partner(df, _partners(spark)).collect()}
    assert out == {"Atlantis": "Unknown", "High seas": "Other", "China": "Asia"}


def test_exclude_keeps_nulls(spark):
    df = spark.createDataFrame([("Extra-EU27",), (None,), ("China",)], "partner string")
    out = sorted((r.partner or "") for r in exclude_values(df, "partner", dims.EXCLUDED_PARTNERS).collect())
    assert out == ["", "China"]


def _cube_doc(product="a tyre", reporter="Portugal"):
    """One reporter, two partners, one product, two indicators, one month."""
    codes = {"reporter": {"PT": reporter}, "partner": {"MA": "Morocco", "NO": "Norway"}, "product": {"40112010": product},
             "indicators": {"QUANTITY_IN_100KG": "q", "VALUE_IN_EUROS": "v"}, "time": {"2019-07": "July"}}
    return json.dumps({
        "label": "small", "updated": "2019-09-01", "id": list(codes), "size": [len(v) for v in codes.values()],
        "dimension": {d: {"category": {"index": {c: k for k, c in enumerate(v)}, "label": v}} for d, v in codes.items()},
        "value": {"1": 71.25, "2": 4.5}, "extension": {"datasetId": "ds-small"}})


def _cubes(spark, *docs):
    return parse_cubes(spark.createDataFrame([(f"d{i}.json", d) for i, d in enumerate(docs)],
                                             "source_path string, json string"))


def test_decode_sparse_cube(spark):
    long = decode_cube(_cubes(spark, _cube_doc()))
    rows = cube_columns(long, ["indicator", "reporter"]).collect()
    assert sorted(r.indicator_code for r in rows) == ["QUANTITY_IN_100KG", "VALUE_IN_EUROS"]
    assert {r.dataset_code for r in rows} == {"ds-small"} and {r.status for r in rows} == {""}


def test_decode_coordinates_labels_status(spark):
    doc = """{"id": ["a", "b", "c"], "size": [2, 2, 3],
      "dimension": {"a": {"category": {"index": {"a0": 0, "a1": 1}, "label": {"a0": "A zero"}}},
                    "b": {"category": {"index": {"b1": 1, "b0": 0}, "label": {}}},
                    "c": {"category": {"index": {"c0": 0, "c1": 1, "c2": 2}, "label": {}}}},
      "value": {"0": 1.0, "7": 2.0, "11": null}, "status": {"7": "p"}}"""
    rows = decode_cube(_cubes(spark, doc)).orderBy("flat_index").collect()
    assert [(dict(r.codes)["a"], dict(r.codes)["b"], dict(r.codes)["c"]) for r in rows] == [
        ("a0", "b0", "c0"), ("a1", "b0", "c1"), ("a1", "b1", "c2")]
    assert [dict(r.labels)["a"] for r in rows] == ["A zero", "a1", "a1"]
    assert [r.status for r in rows] == ["", "p", ""]
    assert rows[2].value is None


def test_conform_cube_tyre_row(spark):
    doc = _cube_doc(dims.TYRE_PRODUCTS[1][0], "Portugal (incl. Madeira)")
    long = decode_cube(_cubes(spark, doc))
    codes = dims.values_df(spark, "code", [c for _l, c, _k in dims.TYRE_PRODUCTS])
    cat = spark.createDataFrame([(c, k) for _l, c, k in dims.TYRE_PRODUCTS], "hs_code string, category string")
    gen = cat.join(dims.tyre_category_dim(spark), "category").select("hs_code", "general_category")
    row = conform_cube(long, "VALUE_IN_EUROS", "value", codes, hs_dims=[cat, gen]).first()
    want = dict(dims.TYRE_CATEGORY_GENERAL)[next(k for _l, c, k in dims.TYRE_PRODUCTS if c == "40112010")]
    assert (row.country, row.partner, row.hs_code, row.general_category, row.value) == (
        "Portugal", "Morocco", "40112010", want, 71.25)


def test_latest_period(spark):
    doc = '{"dimension": {"time": {"category": {"label": {"2024": "2024", "2022": "2022", "2023": "2023"}}}}}'
    fallback = '{"dimension": {"time_period": {"category": {"label": {"2020Q1": "2020Q1", "2021Q2": "2021Q2"}}}}}'
    got = check_latest_periods(latest_period(_cubes(spark, doc, fallback))).orderBy("source_path").collect()
    assert [r.latest_period for r in got] == ["2024", "2021Q2"]
    with pytest.raises(ValueError, match="no dimension of time"):
        check_latest_periods(latest_period(_cubes(spark, '{"dimension": {"geo": {}}}')))
    with pytest.raises(ValueError, match="no labelled period"):
        check_latest_periods(latest_period(_cubes(spark, '{"dimension": {"time": {"category": {"label": {}}}}}')))


def test_matrix_to_long_layout(spark):
    from xlsx import trade_sheet
    cells = trade_sheet(TYRE_A, "VALUE_IN_EUROS", ["China", "China", ""],
                        [("Spain", "2024-01", [1, ":", 3]), ("France", "2024-02", [None, 5, None])])
    cells[(9, 4)] = None  # blank header over a data column
    cells[(3, 8)] = "far right"  # metadata-area cell must not count as a data column
    rows = [("b.xlsx", "p/b.xlsx", dt.datetime(2024, 1, 1), 0, "Sheet 1", r, c, None if v is None else str(v))
            for (r, c), v in cells.items() if v is not None]
    rows.append(("b.xlsx", "p/b.xlsx", dt.datetime(2024, 1, 1), 1, "Notes", 11, 2, "9"))
    df = spark.createDataFrame(rows, "source_name string, source_path string, source_mtime timestamp, "
                                     "sheet_ord int, sheet string, row int, col int, text string")
    out = {(r.country, r.date, r.partner): r.value for r in matrix_to_long(df).collect()}
    assert out == {("Spain", "2024-01", "China"): 1.0, ("Spain", "2024-01", "China.1"): None,
                   ("Spain", "2024-01", "Unnamed: 4"): 3.0, ("France", "2024-02", "China.1"): 5.0}
    meta = matrix_to_long(df).select("frequency", "product", "flow", "indicator").distinct().collect()
    assert [tuple(m) for m in meta] == [("Monthly", TYRE_A, "IMPORT", "VALUE_IN_EUROS")]


def test_conform_tyre_unmapped_category(spark):
    df = spark.createDataFrame([("Tyre Z",)], "product string")
    pd_ = spark.createDataFrame([("Tyre Z", "4011", "Nope")], "product string, hs_code string, category string")
    with pytest.raises(ValueError, match="category -> general_category: Nope"):
        conform_tyre(df, pd_, dims.tyre_category_dim(spark), "tire value")


def test_pad_columns(spark):
    from tradeflow.operators import pad_columns
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, n int")
    row = pad_columns(df, ["n", "x", "y", "z"]).first()
    assert tuple(row) == (1, "a", "", "")
    assert pad_columns(df, ["n", "z"]).columns == ["n", "z"]


def test_require_rows_and_measure_names(spark):
    from tradeflow.operators import measures_of, require_rows
    assert measures_of(" Weight\t") == ("weight",) and measures_of("ALL") == ("value", "weight")
    with pytest.raises(ValueError, match="volume"):
        measures_of("volume")
    with pytest.raises(RuntimeError, match="nothing"):
        require_rows(spark.range(0), "nothing")


def test_strict_inline_survives_later_filters(spark):
    from tradeflow.operators import lookup, strict_inline
    df = spark.createDataFrame([("A", 1.0), ("Z", 2.0)], "product string, value double")
    dim = dims.small_table(spark, [("A", "1", True)], "product string, hs_code string, keep boolean")
    out = strict_inline(lookup(df, dim, "product", ["hs_code", "keep"]), "product", "hs_code", "ctx")
    with pytest.raises(Exception, match="Unmapped values in ctx: product -> hs_code: Z"):
        out.where(F.col("keep")).collect()


def test_workbook_cells_shared_and_rich_strings():
    import io
    import zipfile

    from tradeflow.sources.workbooks import workbook_cells
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
                    '<sheet name="Sheet 1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        zf.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/'
                    'package/2006/relationships"><Relationship Id="rId1" Target="worksheets/s1.xml"/>'
                    '</Relationships>')
        zf.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>Spain</t></si>'
                    '<si><r><t>Ger</t></r><r><t>many</t></r><rPh><t>x</t></rPh></si></sst>')
        zf.writestr("xl/worksheets/s1.xml", f'<worksheet xmlns="{main}"><sheetData><row r="12">'
                    '<c r="A12" t="s"><v>0</v></c><c r="B12" t="s"><v>1</v></c><c r="C12"><v>1.5</v></c>'
                    '<c r="D12" t="b"><v>1</v></c><c r="AA12"><v></v></c></row></sheetData></worksheet>')
    got = list(workbook_cells(buf.getvalue()))
    assert got == [(0, "Sheet 1", 11, 0, "Spain", None, None), (0, "Sheet 1", 11, 1, "Germany", None, None),
                   (0, "Sheet 1", 11, 2, "1.5", None, None), (0, "Sheet 1", 11, 3, "True", None, None)]


def test_scan_workbooks_reports_unreadable_files(spark):
    import tempfile

    from tradeflow.sources.workbooks import require_readable, scan_workbooks, workbook_errors
    from xlsx import trade_sheet, write_xlsx
    d = tempfile.mkdtemp(prefix="tf-wb-")
    write_xlsx(f"{d}/good.xlsx", [("Sheet 1", trade_sheet(TYRE_A, "VALUE_IN_EUROS", ["China"],
                                                         [("Spain", "2024-01", [1])]))])
    with open(f"{d}/bad.xlsx", "wb") as fh:
        fh.write(b"not a zip")
    with open(f"{d}/~$good.xlsx", "wb") as fh:
        fh.write(b"lock file")
    cells = scan_workbooks(spark, d)
    errors = workbook_errors(cells).collect()
    assert [r.source_path.rsplit("/", 1)[-1] for r in errors] == ["bad.xlsx"]
    good = cells.where(F.col("error").isNull())
    assert good.where((F.col("row") == 11) & (F.col("col") == 0)).first().text == "Spain"
    with pytest.raises(ValueError, match="1 workbooks or tabs cannot be read: .*bad.xlsx: BadZipFile"):
        require_readable(cells)


def test_scan_reads_every_file_name_and_drops_missing_texts(spark):
    import tempfile

    from tradeflow.sources.workbooks import list_sources, require_readable, scan_workbooks
    from xlsx import trade_sheet, write_xlsx
    d = tempfile.mkdtemp(prefix="tf-wb-")
    names = ["_x.xlsx", ".y.xlsx", "a [v2].xlsx", "b*?{c}.xlsx", "ü %20.xlsx"]
    for name in names:
        write_xlsx(f"{d}/{name}", [("Sheet 1", trade_sheet(TYRE_A, "VALUE_IN_EUROS", ["China"], [
            ("Spain", "2024-01", [1]), ("NA", "2024-01", [2]), ("n/a", "2024-01", [3]), ("Nauru", "null", [4])]))])
    listing = list_sources(spark, d)
    assert sorted(r.source_name for r in listing.collect()) == sorted(names)
    cells = require_readable(scan_workbooks(spark, listing)).checkpoint()
    rows = cells.where((F.col("row") >= 11) & (F.col("col") < 2)).groupBy("source_name").agg(F.sort_array(F.collect_list("text")).alias("t"))
    assert {r.source_name: r.t for r in rows.collect()} == dict.fromkeys(names, ["2024-01", "2024-01", "2024-01", "Nauru", "Spain"])


def test_date_cells_become_dates(spark):
    import tempfile

    from tradeflow.operators import normalize_trade
    from tradeflow.sources.workbooks import scan_workbooks
    from xlsx import trade_sheet, write_xlsx
    d = tempfile.mkdtemp(prefix="tf-wb-")
    write_xlsx(f"{d}/dates.xlsx", [("Sheet 1", trade_sheet(TYRE_A, "VALUE_IN_EUROS", ["China"], [
        ("Spain", dt.date(2024, 3, 1), [1]), ("Spain", "2024-04", [2]), ("Spain", "2024-05-01", [3])]))])
    long = matrix_to_long(scan_workbooks(spark, d))
    kinds = {r.date: r.date_kind for r in long.collect()}
    assert kinds == {"2024-03-01": "date", "2024-04": None, "2024-05-01": None}
    out = normalize_trade(long, "value", dims.INVALID_REPORTERS, dims.EXCLUDED_PARTNERS, date_kind="date_kind")
    got = sorted((r.date, r.value) for r in out.collect())
    assert got == [(dt.date(2024, 3, 1), 1.0), (dt.date(2024, 4, 1), 2.0)]  # text with a day is not a month


def test_strict_lookup_counts_while_it_writes(spark, monkeypatch):
    import sys

    from tradeflow.operators import UnmappedValues, lookup as plain, materialize_mapped
    module = sys.modules["tradeflow.operators.lookup"]
    dim = spark.createDataFrame([("a", 1)], "k string, v int")
    good = plain(spark.createDataFrame([("a",), (None,)], "k string"), dim, "k")
    audits = []
    audit = module.assert_all_mapped
    monkeypatch.setattr(module, "assert_all_mapped", lambda *a: audits.append(a[2]) or audit(*a))
    assert sorted(materialize_mapped(good, [("k", "v")], "here").collect(), key=str) == sorted(good.collect(), key=str)
    assert audits == []  # nothing unmapped: no second job
    bad = plain(spark.createDataFrame([("a",), ("c",), ("b",), ("c",), (None,)], "k string"), dim, "k")
    with pytest.raises(UnmappedValues, match="Unmapped values in here: k -> v: b, c$") as failed:
        materialize_mapped(bad, [("k", "v")], "here")
    assert audits == ["here"]
    assert sorted(r.value for r in spark.read.parquet(failed.value.table).collect()) == ["b", "c"]
    assert materialize_mapped(good.limit(0), [("k", "v")], "here").collect() == []


def test_lookup_strict_lists_all(spark):
    from tradeflow.operators import lookup_strict
    dim = spark.createDataFrame([("a", 1, "x"), ("b", None, "y")], "k string, v int, w string")
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    assert [tuple(r) for r in lookup_strict(df, dim, "k", ["v", "w"], "t").collect()] == [("a", 1, "x")] * 2
    with pytest.raises(ValueError, match="t: k -> v: b, q; k -> w: q"):
        lookup_strict(spark.createDataFrame([("q",), ("b",), ("a",)], "k string"), dim, "k", ["v", "w"], "t")


def test_a_header_cell_stored_twice_counts_once(spark):
    base = ("b.xlsx", "p/b.xlsx", dt.datetime(2024, 1, 1), 0, "Sheet 1")
    cells = [(4, 2, "M"), (5, 2, "P"), (9, 2, "China"), (9, 2, "China"), (9, 3, "China"), (11, 0, "Spain"), (11, 1, "2024-01"),
             (11, 2, "1"), (11, 3, "2"), (3000, 0, "Malta"), (3000, 1, "2024-02"), (3000, 2, "3")]
    df = spark.createDataFrame([(*base, *c) for c in cells],
                               "source_name string, source_path string, source_mtime timestamp, sheet_ord int, "
                               "sheet string, row int, col int, text string")
    got = sorted((r.row, r.country, r.date, r.partner, r.partner_ord, r.value) for r in matrix_to_long(df).collect())
    assert got == [(11, "Spain", "2024-01", "China", 0, 1.0), (11, "Spain", "2024-01", "China.1", 1, 2.0),
                   (3000, "Malta", "2024-02", "China", 0, 3.0)]
