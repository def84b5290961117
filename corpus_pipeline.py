"""The training-data pipeline: documents in, packed sequences out.

Each stage works on all rows that the one before it kept. Its result is written
as Parquet to the shared folder of the session and read again, so a lost
executor repeats part of one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradeflow.llm import toxicity as toxic
from tradeflow.llm.common import scratch
from tradeflow.llm.decontamination import remove_contaminated
from tradeflow.llm.line_dedup import remove_boilerplate
from tradeflow.llm.ngram_join import keep_one
from tradeflow.llm.packing import pack

#: Toxicity from which a document is rejected: where op6_toxicity predicts toxic.
REJECT = 0.3
#: Bytes of rows that go to a Python worker at once. A batch lies in the
#: executor's memory outside its heap and again in the worker's, once a core.
BATCH_BYTES = "8m"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with rows going to Python in batches of BATCH_BYTES."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)
    return run


@in_small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer, fitted on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxic.score(docs.withColumnRenamed("toxicity", "__toxicity") if "toxicity" in docs.columns else docs,
                         toxic.fit(docs, labels))
    kept = scored.filter(scored["toxicity"] < REJECT).drop("toxicity")
    return kept.toDF(*docs.columns)


@in_small_batches
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur on many sites; near copies stay whole."""
    return remove_boilerplate(docs, prove_copies=True).select(*docs.columns)


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


@in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in sequences of 4096, a row per piece."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("ngram_join", near_duplicates),
          ("decontamination", decontamination), ("packing", packing)]

#: The trained scorer and the tokenizer have no SQL form; tests hold each stage
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
