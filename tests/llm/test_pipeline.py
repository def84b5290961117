"""The pipeline's stages in order, each on all that the one before it kept."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pyarrow as pa
import pytest
from messy import frame, rows

from tradeflow.llm.queries import queries

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    names = list(queries())
    assert [n.split("_")[0] for n in names] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "packing"]
    docs = start = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        own = {r.doc_id for r in after.select("doc_id").collect()}
        assert own and own <= ids, name
        if name == "packing":
            whole = after.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
            assert own == ids and all(r[1] == r[2] for r in whole)
        else:
            assert after.dtypes == start.dtypes, name
        docs, ids = after, own


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_rows(spark, stage):
    docs = frame(spark).withColumnRenamed("score", "toxicity")
    after = stage(spark, docs, SF)
    if stage is not corpus_pipeline.packing:
        assert after.columns == docs.columns
    ids = Counter(r.doc_id for r in after.select("doc_id").collect())
    clean = {0, 3, 5, 9, 15, 300, 301, 302, 400}
    assert clean <= set(ids) and set(ids) <= {i for i, *_ in rows()}
    assert stage(spark, docs.limit(0), SF).collect() == []


def test_what_the_operator_calls_toxic_is_rejected(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(corpus_pipeline.toxic, "fit", lambda docs, labels: None)
    monkeypatch.setattr(corpus_pipeline.toxic, "score", lambda docs, model: docs.withColumn("toxicity", F.col("doc_id") / 10))
    docs = frame(spark, [(k, "text", "en", "s") for k in range(6)])
    assert {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, SF).collect()} == {0, 1, 2}


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_send_small_batches_to_python(spark, stage):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([len(batch)], pa.int64()), "size": pa.array([batch.nbytes], pa.int64())})

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(limit)
    try:
        stage(spark, frame(spark).withColumnRenamed("score", "toxicity").limit(0), SF)
        texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 8192) AS text")
        found = texts.mapInArrow(sizes, "rows long, size long").collect()
        assert sum(r.rows for r in found) == 3000 and max(r["size"] for r in found) < 9 << 20
    finally:
        spark.conf.unset(limit)
