"""Request plans made in parallel: slices are numbers, decoded by tasks.

A plan over lists of indicators, products, years and reporters is the range of
numbers 0 .. n-1 of a mixed radix. Tasks take parts of the range, decode each
number into positions and join the lists by position, so neither the plan nor a
list passes through one row. Rejected slices are replaced by their children as
:func:`~tradeflow.plans.requests.refine_plan` does, reporter chunks by position.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_token, request_url
from ..operators import bounded_broadcast
from ..operators.ranking import with_global_rank
from .requests import TOO_LARGE, chunk_id

#: Slices that one task numbers.
SLICES_A_TASK = 10_000


@dataclass(frozen=True)
class PlanLists:
    """What a plan is over. The tables have their rows' positions 0, 1, ... in
    ``pos``; months and flows are short lists."""
    dataset_code: str
    base_url: str
    indicators: DataFrame  # pos, indicator_alias, indicator_code
    products: DataFrame    # pos, product_group, product_code
    years: DataFrame       # pos, year
    reporters: DataFrame   # pos, reporter
    chunk_size: int
    months: Sequence[int]
    flow: Sequence[str] = ()
    format: str = "JSON"
    frequency: str = "M"


def positioned(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, in the order of ``keys`` (a range-partitioned rank)."""
    return with_global_rank(rows, keys, "__rank").withColumn("pos", F.col("__rank") - 1).drop("__rank")


def _by_position(slices: DataFrame, table: DataFrame, pos: str) -> DataFrame:
    """The list's row at each slice's position."""
    side = table.withColumnRenamed("pos", pos)
    return slices.join(bounded_broadcast(side, check=True), pos).drop(pos)


def numbered_slices(spark: SparkSession, lists: PlanLists) -> DataFrame:
    """All year slices: dataset_code, indicator, product, year, month (null),
    reporter_chunk ``all``, granularity ``year``, times, reporters (null: all)."""
    n = [t.count() for t in (lists.indicators, lists.products, lists.years)]
    total = n[0] * n[1] * n[2]
    k, years, products = F.col("id"), max(1, n[2]), max(1, n[1])
    slices = spark.range(0, total, 1, max(2, -(-total // SLICES_A_TASK))).select(
        F.call_function("div", k, F.lit(years * products).cast("long")).alias("__i"),
        (F.call_function("div", k, F.lit(years).cast("long")) % products).alias("__p"), (k % years).alias("__y"))
    for table, pos in ((lists.indicators, "__i"), (lists.products, "__p"), (lists.years, "__y")):
        slices = _by_position(slices, table, pos)
    months = F.array(*[F.lit(m) for m in lists.months])
    slices = slices.select(
        F.lit(lists.dataset_code).alias("dataset_code"), "indicator_alias", "indicator_code", "product_group", "product_code",
        F.col("year").cast("long").alias("year"), F.lit(None).cast("long").alias("month"), F.lit("all").alias("reporter_chunk"),
        F.lit("year").alias("granularity"), F.transform(months, lambda m: month_token(F.col("year"), m)).alias("times"),
        F.lit(None).cast("array<string>").alias("reporters"))
    return slices.withColumn("cache_path", _path(F.concat(F.col("year").cast("string"), F.lit(".json"))))


def _path(name: Column) -> Column:
    return F.concat_ws("/", "dataset_code", "indicator_alias", "product_code", name)


def reporter_chunks(lists: PlanLists) -> tuple[DataFrame, int]:
    """(__chunk, reporters) and how many there are; ``chunk_size`` of 0: one chunk."""
    n = lists.reporters.count()
    size = lists.chunk_size if lists.chunk_size > 0 else max(1, n)
    held = lists.reporters.groupBy(F.call_function("div", F.col("pos"), F.lit(size).cast("long")).alias("__chunk")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "reporter"))).alias("r"))
    return held.select("__chunk", F.col("r.reporter").alias("reporters")), -(-n // size)


def refine_numbered(slices: DataFrame, rejected: DataFrame, lists: PlanLists) -> DataFrame:
    """One round: slices in ``rejected`` (``cache_path``) by their months, rejected
    months by the chunks of reporters; the others as they are."""
    rejected = rejected.select("cache_path").distinct()
    kept = slices.join(rejected, "cache_path", "left_anti")
    gone = slices.join(rejected, "cache_path", "left_semi")
    token = month_token(F.col("year"), F.col("month"))
    months = gone.where("granularity = 'year'").withColumn("month", F.explode(F.array(*[F.lit(m).cast("long") for m in lists.months])))
    months = months.withColumns({"granularity": F.lit("month"), "times": F.array(token), "cache_path": _path(
        F.concat(token, F.lit(".json")))})
    chunks, n = reporter_chunks(lists)
    # Each rejected month names the chunks by number and meets them by position.
    parts = gone.where("granularity = 'month'").drop("reporters").withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, n - 1)).cast("long"))))
    parts = parts.join(bounded_broadcast(chunks, known_rows=n), "__chunk").withColumns({
        "granularity": F.lit("month_reporter_chunk"), "reporter_chunk": chunk_id(F.col("__chunk")),
        "cache_path": _path(F.concat(token, F.lit("_reporters_"), chunk_id(F.col("__chunk")), F.lit(".json")))}).drop("__chunk")
    finest = gone.where("granularity NOT IN ('year', 'month')")
    return kept.unionByName(finest).unionByName(months).unionByName(parts)


def rejected_paths(outcomes: DataFrame) -> DataFrame:
    """Paths whose request was too large."""
    return outcomes.where(F.col("status_code") == TOO_LARGE).select("cache_path")


def with_urls(slices: DataFrame, lists: PlanLists) -> DataFrame:
    """``slices`` with request_url and all reporters where a slice asks for all of
    them. Such a URL names every reporter, so their list is as long as one URL."""
    every = [r.reporter for r in lists.reporters.orderBy("pos").select("reporter").collect()]
    out = slices.withColumn("reporters", F.coalesce("reporters", F.array(*[F.lit(r) for r in every]).cast("array<string>")))
    url = request_url(F.lit(lists.base_url), F.col("dataset_code"), F.lit(lists.format), F.lit(lists.frequency),
                      F.array(*[F.lit(f) for f in lists.flow]).cast("array<string>"), F.col("reporters"), F.col("product_code"),
                      F.col("indicator_code"), F.col("times"))
    return out.withColumn("request_url", url)
