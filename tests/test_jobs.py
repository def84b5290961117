"""Incremental stage builds: every run equals a full rebuild from the same files."""

from __future__ import annotations

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tradeflow.jobs.stages import StageLayout, build_all, build_merged, build_stage, build_stages, stage_spec
from tradeflow import dims
from xlsx import trade_sheet, write_xlsx

TYRE_A = "New pneumatic tyres, of rubber, of a kind used for motor cars, incl. station wagons and racing cars"
TYRE_B = "Pneumatic tyres, new, of rubber, of a kind used for buses or lorries, with a load index of > 121"


def _book(path, rows, mtime):
    write_xlsx(path, [
        ("Sheet 1", trade_sheet(TYRE_A, "VALUE_IN_EUROS", ["China", "Japan", "Extra-EU27"], rows)),
        ("Sheet 2", trade_sheet(TYRE_B, "VALUE_IN_EUROS", ["China", "Japan", "Extra-EU27"], rows)),
        ("Notes", {(0, 0): "ignored"}),
    ])
    os.utime(path, (mtime, mtime))


def _stage_rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(
        "country", "date", "product", "partner", "value", "hs_code", "category", "general_category").collect())


def _run(spark, root, src, full):
    layout = StageLayout((src,), f"{root}/cache", f"{root}/stage")
    years = build_stage(spark, stage_spec("tyre", "value"), layout, f"{root}/manifest", full_refresh=full)
    return years, layout


@pytest.fixture()
def sources():
    base = tempfile.mkdtemp(prefix="tf-src-")
    yield base


def test_incremental_equals_full_refresh(spark, sources):
    now = time.time() - 1000
    _book(f"{sources}/a.xlsx", [("Germany (incl. DD from 1991)", "2024-01", [10, ":", 7]),
                                ("Spain", "2024-2", [1.5, 2, 3])], now)
    _book(f"{sources}/b.xlsx", [("Germany", "2023-12", [5, 6, None])], now + 1)
    inc = tempfile.mkdtemp(prefix="tf-inc-")
    years, layout = _run(spark, inc, sources, full=False)
    assert years == [2023, 2024]
    first = _stage_rows(spark, layout.stage)
    assert ("Germany", __import__("datetime").date(2024, 1, 1), TYRE_A, "China", 10.0, "401110", "PCR", "PCR") in first
    assert all(r[3] != "Extra-EU27" for r in first)

    # change a (restates Jan 2024 with a newer file), remove b, add c
    _book(f"{sources}/a.xlsx", [("Germany", "2024-01", [11, 4, 7])], now + 10)
    os.remove(f"{sources}/b.xlsx")
    _book(f"{sources}/c.xlsx", [("France", "2022-05", [1, 2, 3])], now + 20)
    years, layout = _run(spark, inc, sources, full=False)
    assert years == [2022, 2023, 2024]
    incremental = _stage_rows(spark, layout.stage)

    full = tempfile.mkdtemp(prefix="tf-full-")
    _run(spark, full, sources, full=True)
    assert incremental == _stage_rows(spark, f"{full}/stage")
    assert not any(r[1].year == 2023 for r in incremental)  # b's only year is gone

    # restore b unchanged: its rows come back
    _book(f"{sources}/b.xlsx", [("Germany", "2023-12", [5, 6, None])], now + 1)
    years, layout = _run(spark, inc, sources, full=False)
    assert 2023 in years
    restored = _stage_rows(spark, layout.stage)
    full2 = tempfile.mkdtemp(prefix="tf-full-")
    _run(spark, full2, sources, full=True)
    assert restored == _stage_rows(spark, f"{full2}/stage")

    # nothing changed: nothing rebuilt
    years, _ = _run(spark, inc, sources, full=False)
    assert years == []


def test_unmapped_product_fails_with_full_list(spark, sources):
    write_xlsx(f"{sources}/x.xlsx", [
        ("Sheet 1", trade_sheet("Unknown tyre B", "VALUE_IN_EUROS", ["China"], [("Spain", "2024-01", [1])])),
        ("Sheet 2", trade_sheet("Unknown tyre A", "VALUE_IN_EUROS", ["China"], [("Spain", "2024-01", [1])])),
    ])
    root = tempfile.mkdtemp(prefix="tf-bad-")
    with pytest.raises(ValueError, match="Unknown tyre A, Unknown tyre B"):
        _run(spark, root, sources, full=False)


def test_a_damaged_workbook_stops_the_build_and_keeps_the_stage(spark, sources):
    now = time.time() - 1000
    _book(f"{sources}/a.xlsx", [("Spain", "2024-01", [1, 2, 3])], now)
    _book(f"{sources}/b [v2].xlsx", [("Malta", "2023-01", [4, 5, 6])], now + 1)
    _book(f"{sources}/_c.xlsx", [("Italy", "2022-01", [7, 8, 9])], now + 2)
    root = tempfile.mkdtemp(prefix="tf-dmg-")
    years, layout = _run(spark, root, sources, full=False)
    assert years == [2022, 2023, 2024]
    before = _stage_rows(spark, layout.stage)
    with open(f"{sources}/a.xlsx", "wb") as fh:
        fh.write(b"no workbook")
    with pytest.raises(ValueError, match="1 workbooks or tabs cannot be read: .*a.xlsx"):
        _run(spark, root, sources, full=False)
    assert _stage_rows(spark, layout.stage) == before


def test_a_source_without_kept_rows_is_read_once(spark, sources, monkeypatch):
    import tradeflow.jobs.stages as jobs
    _book(f"{sources}/a.xlsx", [("Spain", "2024-01", [1, 2, 3])], time.time() - 1000)
    _book(f"{sources}/none.xlsx", [("Spain", "2024-01", [":", ":", ":"])], time.time() - 1000)
    scans = []
    scan = jobs.scan_workbooks
    monkeypatch.setattr(jobs, "scan_workbooks", lambda s, files: scans.append(files.count()) or scan(s, files))
    root = tempfile.mkdtemp(prefix="tf-none-")
    _run(spark, root, sources, full=False)
    _run(spark, root, sources, full=False)
    assert scans == [2]
    manifest = spark.read.parquet(f"{root}/manifest").collect()
    assert {r.source_name: r.row_count for r in manifest}["none.xlsx"] == 0


def test_build_all_and_vehicle_stage(spark, sources):
    vehicle = dims.VEHICLE_PRODUCTS[0][0]
    now, layouts = time.time() - 1000, {}
    root = tempfile.mkdtemp(prefix="tf-all-")
    for module, product in (("tyre", TYRE_A), ("vehicle", vehicle)):
        for measure, code in (("value", "VALUE_IN_EUROS"), ("weight", "QUANTITY_IN_100KG")):
            d = f"{sources}/{module}_{measure}"
            os.makedirs(d)
            write_xlsx(f"{d}/s.xlsx", [("Sheet 1", trade_sheet(product, code, ["China"], [("Malta", "2019-05", [6])]))])
            os.utime(f"{d}/s.xlsx", (now, now))
            layouts[module, measure] = StageLayout((d,), f"{root}/{module}_{measure}/c", f"{root}/{module}_{measure}/s")
    partners = spark.createDataFrame([("China", "Asia", "Eastern Asia")],
                                     "partner string, partner_continent string, partner_sub_region string")
    assert build_all(spark, layouts, f"{root}/m", partners, f"{root}/out", combined=f"{root}/combined") == [2019]
    rows = spark.read.parquet(f"{root}/out").collect()
    assert {(r.type, r.value, r.weight) for r in rows} == {("Tyre", 6.0, 600.0), ("Vehicle", 6.0, 600.0)}
    assert [r.date for r in spark.read.parquet(f"{root}/combined").collect()] == ["2019-05-01"] * 2
    assert build_stages(spark, "vehicle", "all", layouts, f"{root}/m") == []
    with pytest.raises(ValueError, match="build_stages"):
        stage_spec("tyre", "all")


def test_merge_reads_fallbacks_and_missing_stages(spark):
    legacy = spark.createDataFrame([("Malta", "2018-02-01", TYRE_A, "i", "China", 3.0, 2, "401110", "PCR", "PCR")],
                                   "country string, date string, product string, indicator string, partner string, "
                                   "value double, month int, hs_code string, category string, general_category string")
    root = tempfile.mkdtemp(prefix="tf-fall-")
    partners = spark.createDataFrame([], "partner string, partner_continent string, partner_sub_region string")
    fallbacks = {("tyre", "value"): legacy, ("tyre", "weight"): legacy.withColumnRenamed("value", "weight")}
    stages = {k: f"{root}/{k[0]}_{k[1]}" for k in fallbacks}
    assert build_merged(spark, stages, partners, f"{root}/out", fallbacks=fallbacks) == [2018]
    rows = spark.read.parquet(f"{root}/out").collect()
    assert [(r.value, r.weight, r.partner_continent) for r in rows] == [(3.0, 300.0, "Unknown")]


def test_merge_aligns_stages(spark, sources):
    now = time.time() - 1000
    root = tempfile.mkdtemp(prefix="tf-merge-")
    layouts = {}
    for module, measure, product, ind in [("tyre", "value", TYRE_A, "VALUE_IN_EUROS"),
                                          ("tyre", "weight", TYRE_A, "QUANTITY_IN_100KG")]:
        d = f"{sources}/{module}_{measure}"
        os.makedirs(d)
        write_xlsx(f"{d}/s.xlsx", [("Sheet 1", trade_sheet(product, ind, ["China"],
                                                           [("Spain", "2024-01", [10 if measure == "value" else 2])]))])
        os.utime(f"{d}/s.xlsx", (now, now))
        layouts[(module, measure)] = StageLayout((d,), f"{root}/{module}_{measure}/cache",
                                                 f"{root}/{module}_{measure}/stage")
        build_stage(spark, stage_spec(module, measure), layouts[(module, measure)], f"{root}/manifest")
    empty = spark.createDataFrame([], "country string, date date, product string, indicator string, "
                                      "partner string, value double, year int, month int, hs_code string, "
                                      "general_category string")
    stages = {k: v.stage for k, v in layouts.items()}
    for measure in ("value", "weight"):
        p = f"{root}/vehicle_{measure}/stage"
        empty.withColumnRenamed("value", measure).write.partitionBy("year").parquet(p)
        stages[("vehicle", measure)] = p
    partners = spark.createDataFrame([("China", "Asia", "Eastern Asia")],
                                     "partner string, partner_continent string, partner_sub_region string")
    years = build_merged(spark, stages, partners, f"{root}/merged")
    assert years == [2024]
    out = spark.read.parquet(f"{root}/merged").collect()
    assert len(out) == 1
    row = out[0]
    assert (row.value, row.weight, row.type, row.partner_continent) == (10.0, 200.0, "Tyre", "Asia")


def test_a_bucketed_cache_gives_the_same_stage(spark, sources):
    now = time.time() - 1000
    _book(f"{sources}/a.xlsx", [("Spain", "2024-01", [10, 2, 7]), ("Spain", "2023-02", [1, 2, 3])], now)
    _book(f"{sources}/b.xlsx", [("Spain", "2024-01", [11, 3, 8]), ("Malta", "2024-01", [4, 5, 6])], now + 1)
    root = tempfile.mkdtemp(prefix="tf-bkt-")
    layout = StageLayout((sources,), f"{root}/cache", f"{root}/stage", cache_table="tyre_value_cache", cache_buckets=4)
    spec = stage_spec("tyre", "value")
    assert build_stage(spark, spec, layout, f"{root}/manifest") == [2023, 2024]
    _run(spark, f"{root}/plain", sources, full=True)
    assert _stage_rows(spark, layout.stage) == _stage_rows(spark, f"{root}/plain/stage")
    _book(f"{sources}/b.xlsx", [("Spain", "2024-01", [12, 3, 8])], now + 2)
    spark.sql("DROP TABLE tyre_value_cache")  # as in a new session: the files alone remain
    assert build_stage(spark, spec, layout, f"{root}/manifest") == [2024]
    _run(spark, f"{root}/again", sources, full=True)
    assert _stage_rows(spark, layout.stage) == _stage_rows(spark, f"{root}/again/stage")
