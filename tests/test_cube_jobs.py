"""Cube ingestion jobs and the streaming landing ingest on a small landing folder."""

from __future__ import annotations

import json
import os
import tempfile

import pytest

from tradeflow.jobs.cubes import ingest_cubes, latest_periods
from tradeflow.operators.cube import CONFORM_DIMS, decode_cube
from tradeflow.plans.requests import probe_plan
from tradeflow.sources.cubes import parse_cubes
from tradeflow.streaming.landing import start_landing_ingest



def _doc(year, cells, product="40112090"):
    """Two reporters x three partners x one product x two indicators x two months."""
    months = [f"{year}-03", f"{year}-04"]
    sides = {"reporter": {"IT": "Italy (incl. San Marino)", "PL": "Poland"},
             "partner": {"VN": "Viet Nam", "EXTRA": "Extra-EU27", "BR": "Brazil"},
             "product": {product: "a tyre"}, "indicators": {"QUANTITY_IN_100KG": "q", "VALUE_IN_EUROS": "v"},
             "time": {m: m for m in months}}
    return {"label": "small cube", "updated": "2019-06-01T08:30:00+0200", "id": list(sides),
            "size": [len(v) for v in sides.values()], "value": cells, "extension": {"datasetId": "ds-test"},
            "dimension": {d: {"category": {"index": {c: k for k, c in enumerate(v)}, "label": v}} for d, v in sides.items()}}


def _cell(reporter, partner, indicator, month):
    return str(((reporter * 3 + partner) * 2 + indicator) * 2 + month)


def _land(root, rel, doc):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump(doc, fh)


def test_ingest_cubes_writes_stage_inputs(spark):
    landing = tempfile.mkdtemp(prefix="tf-landing-")
    cells = {_cell(0, 0, 1, 0): 125.5, _cell(0, 0, 0, 0): 3.25, _cell(1, 2, 1, 1): 64.0, _cell(1, 1, 1, 1): 9.0}
    _land(landing, "ds-test/value/40112090/2018.json", _doc(2018, cells))
    out = tempfile.mkdtemp(prefix="tf-cube-out-")
    paths = ingest_cubes(spark, landing, out)
    assert spark.read.parquet(paths["long"]).count() == 4
    tyre = spark.read.parquet(paths["tyre_value"]).collect()
    assert {(r.country, r.partner, r.hs_code, str(r.date), r.value) for r in tyre if r.partner != "Extra-EU27"} == {
        ("Italy", "Viet Nam", "40112090", "2018-03-01", 125.5), ("Poland", "Brazil", "40112090", "2018-04-01", 64.0)}
    weight = spark.read.parquet(paths["tyre_weight"]).collect()
    assert [(r.partner, r.weight) for r in weight] == [("Viet Nam", 3.25)]
    probes = probe_plan(spark, "https://a.example/data/ds-test?format=JSON", "https://a.example/stats", ["other"])
    assert [r.source_url for r in probes.collect()] == [
        "https://a.example/data/ds-test?format=JSON", "https://a.example/stats/other?format=JSON"]
    periods = latest_periods(spark, landing, probes=probes).collect()
    assert [(r.latest_period, r.api_type) for r in periods] == [("2018-04", "comext")]

    # A year that is no longer landed leaves the stage tables.
    os.remove(f"{landing}/ds-test/value/40112090/2018.json")
    _land(landing, "ds-test/value/40112090/2019.json", _doc(2019, cells))
    paths = ingest_cubes(spark, landing, out)
    assert [r.year for r in spark.read.parquet(paths["tyre_value"]).select("year").distinct().collect()] == [2019]


@pytest.mark.parametrize("damage", [
    lambda t: t[:len(t) // 2], lambda t: t.replace('"value": {', '"value": [{', 1).replace('}, "extension"', '}], "extension"', 1),
    lambda t: t.replace("125.5", '"n/a"'), lambda t: t.replace('"index": {"IT": 0, "PL": 1}', '"index": ["IT", "PL"]'),
    lambda t: t.replace('{"IT": 0, "PL": 1}', '{"IT": 0}')])
def test_a_response_that_cannot_be_decoded_stops_the_ingest(spark, damage):
    landing, out = tempfile.mkdtemp(prefix="tf-landing-"), tempfile.mkdtemp(prefix="tf-cube-out-")
    doc = _doc(2018, {_cell(0, 0, 1, 0): 125.5, _cell(1, 0, 1, 0): 2.0})
    _land(landing, "ds-test/value/40112090/2018.json", doc)
    path = f"{landing}/ds-test/value/40112090/2019.json"
    damaged = damage(json.dumps(doc))
    assert damaged != json.dumps(doc)
    with open(path, "w") as fh:
        fh.write(damaged)
    with pytest.raises(ValueError, match="1 response documents cannot be decoded: .*2019.json"):
        ingest_cubes(spark, landing, out)
    assert os.listdir(out) == []


def test_positions_with_gaps_and_many_dimensions(spark):
    names = [f"d{k:02d}" for k in range(20)]
    doc = {"id": names, "size": [2] * 20, "extension": {"datasetId": "wide"}, "value": {str(2 ** 20 - 1): 1.0, "0": 2.0},
           "dimension": {d: {"category": {"index": {"b": 1, "a": 0}, "label": {}}} for d in names}}
    gap = {"id": ["x"], "size": [3], "value": {"2": 5.0}, "dimension": {"x": {"category": {"index": {"last": 2, "first": 0},
                                                                                     "label": {"last": "Last"}}}}}
    texts = spark.createDataFrame([("wide", json.dumps(doc)), ("gap", json.dumps(gap))], "source_path string, json string")
    rows = {(r.source_path, r.flat_index): r for r in decode_cube(parse_cubes(texts)).collect()}
    assert dict(rows["wide", 2 ** 20 - 1].codes) == dict.fromkeys(names, "b")
    assert dict(rows["wide", 0].codes) == dict.fromkeys(names, "a")
    assert dict(rows["gap", 2].labels) == {"x": "Last"}
    wanted = decode_cube(parse_cubes(texts), dims=["x", "d19"]).collect()
    assert {(r.source_path, r.x_code, r.d19_code) for r in wanted} == {("wide", None, "a"), ("wide", None, "b"), ("gap", "last", None)}


def test_a_document_is_parsed_once(spark):
    texts = spark.createDataFrame([("a", json.dumps(_doc(2018, {"0": 1.0})))], "source_path string, json string")
    for df in (decode_cube(parse_cubes(texts)), decode_cube(parse_cubes(texts), dims=CONFORM_DIMS).where("product_code = 'x'")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_streaming_landing_ingest_once_per_file(spark):
    landing = tempfile.mkdtemp(prefix="tf-stream-in-")
    out = tempfile.mkdtemp(prefix="tf-stream-out-") + "/cells"
    ckpt = tempfile.mkdtemp(prefix="tf-stream-ckpt-")
    _land(landing, "a/2024.json", _doc(2024, {"0": 1.0}))
    q = start_landing_ingest(spark, landing, out, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 1
    _land(landing, "a/2025.json", _doc(2025, {"0": 1.0, "3": 4.0}))
    q = start_landing_ingest(spark, landing, out, ckpt)
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.flat_index for r in rows) == [0, 0, 3]


def test_request_manifest_from_config(spark):
    from tradeflow.plans.requests import read_request_config, request_plan
    cfg_dir = tempfile.mkdtemp(prefix="tf-cfg-")
    config = {
        "dataset_code": "ds-045409", "base_url": "https://host/data/", "format": "JSON", "frequency": "M",
        "flow": ["1"], "reporters": ["DE", "FR"], "reporter_chunk_size": 1, "years": [2024, 2025],
        "months": [1, 2], "indicators": {"value": "VALUE_IN_EUROS"}, "products": {"tire": ["401110"]},
    }
    with open(f"{cfg_dir}/config.json", "w") as fh:
        json.dump(config, fh)
    plan = request_plan(read_request_config(spark, f"{cfg_dir}/config.json"))
    assert plan.count() == 2
    landing = tempfile.mkdtemp(prefix="tf-landing-")
    _land(landing, "ds-045409/value/401110/2025.json", _doc(2025, {"0": 1.0, "1": 2.0}, "401110"))
    _land(landing, "ds-045409/value/401110/2024-07_reporters_101.json", _doc(2024, {"0": 1.0}, "401110"))
    paths = ingest_cubes(spark, landing, tempfile.mkdtemp(prefix="tf-cube-out-"), plan)
    rows = {"extra" if "_reporters_" in r.cache_path else r.year: r for r in spark.read.parquet(paths["requests"]).collect()}
    assert rows["2025"].success and rows["2025"].cell_count == 2 and rows["2025"].status_code == "200"
    assert len(rows) == 3
    assert not rows["2024"].success and rows["2024"].cell_count is None
    extra = rows["extra"]  # landed, but not in the plan
    assert (extra.month, extra.reporter_chunk, extra.granularity, extra.cell_count) == ("7", "101", "month_reporter_chunk", 1)
    assert rows["2025"].request_url.startswith(
        "https://host/data/ds-045409?format=JSON&freq=M&flow=1&reporter=DE&reporter=FR&product=401110")
