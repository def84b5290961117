"""Year-partition reads with fallback, partition overwrite/delete, sorted export."""

from __future__ import annotations

import datetime as dt
import glob
import tempfile

from tradeflow.sinks.tables import export_sorted, overwrite_years
from tradeflow.sources.stage import read_stage, read_year_or_fallback


def test_overwrite_read_fallback_and_export(spark):
    root = tempfile.mkdtemp(prefix="tf-sink-")
    rows = [("B", dt.date(2023, 5, 1), "10", 2023), ("A", dt.date(2024, 1, 1), "9", 2024),
            ("A", dt.date(2024, 1, 1), "10", 2024), ("C", dt.date(2022, 1, 1), "1", 2022)]
    df = spark.createDataFrame(rows, "country string, date date, hs_code string, year int")
    overwrite_years(spark, df, f"{root}/stage")
    assert sorted(r.year for r in read_stage(spark, f"{root}/stage").select("year").distinct().collect()) == \
        [2022, 2023, 2024]

    # rewrite 2024 only and drop 2022 (no rows left); 2023 untouched
    new = spark.createDataFrame([("A", dt.date(2024, 2, 1), "11", 2024)], df.schema)
    overwrite_years(spark, new, f"{root}/stage", empty_years=[2022])
    got = sorted((r.year, r.hs_code) for r in read_stage(spark, f"{root}/stage").collect())
    assert got == [(2023, "10"), (2024, "11")]
    assert [r.hs_code for r in read_stage(spark, f"{root}/stage", [2023]).collect()] == ["10"]

    legacy = spark.createDataFrame([("Z", dt.date(2021, 3, 1), "7"), ("Z", dt.date(2020, 3, 1), "8")],
                                   "country string, date date, hs_code string")
    fb = read_year_or_fallback(spark, f"{root}/stage", 2021, legacy).collect()
    assert [r.hs_code for r in fb] == ["7"]
    assert [r.hs_code for r in read_year_or_fallback(spark, f"{root}/stage", 2023, legacy).collect()] == ["10"]

    export_sorted(df, f"{root}/combined", ["country", "date", "hs_code"], numeric=["hs_code"], single_file=True,
                  fmt="csv")
    files = glob.glob(f"{root}/combined/part-*.csv")
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    assert [line.split(",")[:3] for line in lines[1:]] == [
        ["A", "2024-01-01", "9"], ["A", "2024-01-01", "10"], ["B", "2023-05-01", "10"], ["C", "2022-01-01", "1"]]


def test_first_available_source(spark):
    import os

    import pytest

    from tradeflow.sources.workbooks import first_available_source, list_sources
    from xlsx import write_xlsx
    empty, lock_only, good = (tempfile.mkdtemp(prefix=f"tf-src{i}-") for i in range(3))
    with open(f"{lock_only}/~$a.xlsx", "wb") as fh:
        fh.write(b"lock")
    write_xlsx(f"{good}/a b.xlsx", [("Sheet 1", {(0, 0): "x"})])
    missing = f"{empty}/nope"
    assert first_available_source(spark, [missing, empty, lock_only, good]) == good
    with pytest.raises(FileNotFoundError, match="Checked: .*nope.*tf-src0"):
        first_available_source(spark, [missing, empty])
    row = list_sources(spark, good).first()
    assert row.source_name == "a b.xlsx" and row.size_bytes == os.path.getsize(f"{good}/a b.xlsx")
    assert row.fingerprint.startswith(f"{row.size_bytes}-")


def test_a_large_year_is_written_by_several_tasks(spark):
    root = tempfile.mkdtemp(prefix="tf-split-")
    df = spark.range(200_000).selectExpr("cast(id % 1000 as string) as hs_code", "cast(id as string) as country",
                                         "2020 + cast(id % 10 = 0 as int) as year")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        overwrite_years(spark, df, f"{root}/ranged", sort_within=["country"])
        overwrite_years(spark, df, f"{root}/split")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for table in ("ranged", "split"):
        assert len(glob.glob(f"{root}/{table}/year=2020/part-*")) > 1
        assert spark.read.parquet(f"{root}/{table}").count() == 200_000


def test_manifest_versions_without_success_mark_are_not_read(spark):
    import os

    from tradeflow.operators.increment import MANIFEST_SCHEMA
    from tradeflow.sinks.tables import write_versioned
    from tradeflow.sources.stage import read_manifest
    root = tempfile.mkdtemp(prefix="tf-man-") + "/m"
    assert read_manifest(spark, root).count() == 0
    empty = spark.createDataFrame([], MANIFEST_SCHEMA)
    row = spark.createDataFrame([tuple(["tyre"] + [None] * (len(MANIFEST_SCHEMA.fields) - 1))], MANIFEST_SCHEMA)
    write_versioned(row, root, "1")
    os.remove(write_versioned(empty, root, "2") + "/_SUCCESS")
    assert read_manifest(spark, root).count() == 1


def test_duplicate_dimension_keys_fail(spark):
    import pytest

    from tradeflow.operators import lookup
    facts = spark.createDataFrame([("China", 1)], "partner string, v int")
    dim = spark.createDataFrame([("China", "Asia"), ("China", "Elsewhere")], "partner string, place string")
    with pytest.raises(Exception, match="two rows for China"):
        lookup(facts, dim, "partner").collect()
    assert lookup(facts, dim.limit(1), "partner").first().place == "Asia"
