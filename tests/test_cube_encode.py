"""Encoding cubes in pieces, and decoding documents larger than a task."""

from __future__ import annotations

import glob
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tradeflow.operators import cube_encode
from tradeflow.operators.cube import decode_cube
from tradeflow.operators.cube_encode import CubeDim, dense_positions, document_rows, encode_cubes, write_documents
from tradeflow.sources.cubes import cube_errors, parse_cubes, scan_cubes
from tradeflow.sources.large_cubes import decode_large, require_whole_large, scan_large_cubes

DIMS = ["reporter", "product", "time"]


def _header():
    return {"label": F.concat(F.lit('a "quoted", label {'), F.col("doc"), F.lit("}")), "updated": F.lit(None).cast("string"),
            "datasetId": F.col("doc")}


def _cells(spark, n=500):
    rows = [(f"d{k % 3}", f"R{k % 17}", f"P,{k % 5}", f"20{10 + k % 13}-01", None if k % 50 == 7 else k / 8,
             "p" if k % 9 == 0 else ("" if k % 2 else None)) for k in range(n)]
    # One cell a place.
    rows = list({r[:4]: r for r in rows}.values())
    return rows, spark.createDataFrame(rows, "doc string, reporter string, product string, time string, value double, status string")


def _dims(spark):
    reporters = spark.createDataFrame(
        [(f"R{k}", None if k == 3 else f'Länd "{k}", {{incl. X}}') for k in range(20)], "code string, label string")
    return [CubeDim("reporter", "reporter", reporters), CubeDim("product", "product"), CubeDim("time", "time")]


def _expected(rows):
    def label(code):
        return code if code == "R3" else f'Länd "{code[1:]}", {{incl. X}}'
    return sorted((d, r, label(r), p, t, -1.0 if v is None else v, s or "") for d, r, p, t, v, s in rows)


def _found(long):
    return sorted((r.dataset_code, r.reporter_code, r.reporter_label, r.product_code, r.time_code,
                   -1.0 if r.value is None else r.value, r.status) for r in long.collect())


@pytest.mark.parametrize("cells,categories", [(8192, 4096), (7, 3), (1, 1)])
def test_decode_of_encode_is_the_identity(spark, monkeypatch, cells, categories):
    monkeypatch.setattr(cube_encode, "CELLS_A_PIECE", cells)
    monkeypatch.setattr(cube_encode, "CATEGORIES_A_PIECE", categories)
    rows, df = _cells(spark)
    pieces = encode_cubes(df, ["doc"], _dims(spark), _header()).checkpoint()
    texts = document_rows(pieces, ["doc"]).withColumnRenamed("doc", "source_path")
    for r in texts.collect():
        body = json.loads(r.json)
        assert body["id"] == DIMS and body["size"][0] == 20 and body["label"] == f'a "quoted", label {{{r.source_path}}}'
        assert list(body["dimension"]["reporter"]["category"]["index"].values()) == list(range(20))
        assert "R3" not in body["dimension"]["reporter"]["category"]["label"]
    cubes = parse_cubes(texts)
    assert cube_errors(cubes).collect() == []
    assert _found(decode_cube(cubes, dims=DIMS)) == _expected(rows)
    if cells > 7:
        folder = f"{tempfile.mkdtemp(prefix='tf-enc-')}/docs"
        write_documents(pieces, folder, "doc")
        assert len(glob.glob(f"{folder}/doc=*/*.txt")) == 3  # a file per document
        assert _found(decode_cube(scan_cubes(spark, folder, glob="*.txt"), dims=DIMS)) == _expected(rows)


def test_no_piece_grows_with_the_document(spark, monkeypatch):
    monkeypatch.setattr(cube_encode, "CELLS_A_PIECE", 50)
    monkeypatch.setattr(cube_encode, "CATEGORIES_A_PIECE", 5)
    _, df = _cells(spark, 3000)
    pieces = encode_cubes(df, ["doc"], _dims(spark), _header())
    longest, n = pieces.agg(F.max(F.length("text")), F.count("*")).first()
    assert n > 60 and longest < 2000


def test_dense_positions(spark):
    df = spark.createDataFrame([(f"c{k:03d}", str(k)) for k in (5, 1, 9, 3, 700, 70)], "code string, label string").repartition(4)
    assert sorted((r.code, r.pos) for r in dense_positions(df).collect()) == [
        ("c001", 0), ("c003", 1), ("c005", 2), ("c009", 3), ("c070", 4), ("c700", 5)]


# --- documents read by byte ranges ---------------------------------------------

def _document(k=0, **changes):
    doc = {"label": f"doc {k}, of {{many}} \"value\":{{}}", "updated": "u", "id": DIMS, "size": [2, 2, 3],
           "dimension": {
               "reporter": {"category": {"index": {"A": 0, "401110": 1}, "label": {"A": "Aland, [the] isles"}}},
               "product": {"category": {"index": {"P": 0, "Q": 1}, "label": {"P": "tyres, of rubber", "Q": "q}"}}},
               "time": {"category": {"index": {"2020": 0, "2021": 1, "2022": 2}, "label": {}}}},
           "value": {str(i): i + 0.5 + k for i in range(0, 12, 1 + k % 3)}, "status": {"0": "p", "6": "c"},
           "extension": {"datasetId": f"ds{k}"}}
    doc.update(changes)
    return doc


def _land(texts):
    folder = tempfile.mkdtemp(prefix="tf-large-")
    for name, text in texts.items():
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w") as fh:
            fh.write(text)
    return folder


def _rows(df):
    return sorted(tuple(repr(v) for v in r) for r in df.collect())


@pytest.fixture()
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("layout", [{}, {"indent": 1}, {"separators": (",", ":")}])
def test_ranges_give_what_whole_files_give(spark, small_ranges, layout):
    folder = _land({
        **{f"x/{k}.json": json.dumps(_document(k), **layout) for k in range(4)},
        "empty.json": json.dumps(_document(5, value={}, status={}), **layout),
        "no_status.json": json.dumps({k: v for k, v in _document(6).items() if k != "status"}, **layout),
        "null.json": json.dumps(_document(7, value={"3": None, "5": -1e-7, "11": 2}), **layout) + "\n",
        "order.json": json.dumps(dict(reversed(_document(8).items())), **layout),
    })
    whole = decode_cube(scan_cubes(spark, folder), dims=DIMS)
    cubes = require_whole_large(scan_large_cubes(spark, folder))
    assert spark.read.option("lineSep", ",").text(f"{folder}/x").rdd.getNumPartitions() > 4  # files
    assert _rows(decode_large(cubes, DIMS).select(*whole.columns)) == _rows(whole)
    assert whole.count() > 30


def test_one_long_document_is_many_tasks(spark, small_ranges):
    doc = _document(0, size=[2, 2, 5000], value={str(i): float(i) for i in range(20_000)},
                    status={str(i): "e" for i in range(0, 20_000, 7)})
    doc["dimension"]["time"]["category"] = {"index": {f"t{i}": i for i in range(5000)}, "label": {}}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    folder = _land({"long.json": json.dumps(doc)})
    cubes = scan_large_cubes(spark, folder)
    assert cubes.errors.collect() == []
    long = decode_large(cubes, DIMS)
    assert _rows(long) == _rows(decode_cube(scan_cubes(spark, folder), dims=DIMS).select(*long.columns))


def test_errors_name_the_file_as_with_whole_files(spark, small_ranges):
    good, text = json.dumps(_document(1)), json.dumps(_document(2))
    folder = _land({
        "good.json": good, "cut.json": text[:len(text) // 2], "cut_in_cells.json": text[:text.index('"value": {"0"') + 30],
        "list.json": json.dumps(_document(3, value=[1.0, 2.0])), "text.json": json.dumps(_document(4, value={"0": "n/a"})),
        "no_dims.json": json.dumps({"value": {"0": 1.0}}), "short.json": json.dumps(_document(5, size=[2, 2, 9])),
        "nothing.json": "not json"})
    expected = {os.path.basename(r.source_path): r.error for r in cube_errors(scan_cubes(spark, folder)).collect()}
    cubes = scan_large_cubes(spark, folder)
    assert {os.path.basename(r.source_path): r.error for r in cubes.errors.collect()} == expected
    assert set(expected) == {"cut.json", "cut_in_cells.json", "list.json", "text.json", "no_dims.json", "short.json", "nothing.json"}
    with pytest.raises(ValueError, match="7 response documents cannot be decoded: .*cut.json"):
        require_whole_large(cubes)
