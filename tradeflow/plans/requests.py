"""Request-slice planning for a statistics API, as table operators.

A config row (dataset, base URL, flows, reporters, chunk size, years, months,
indicators map, products map of arrays) expands to year slices; an outcomes
table (cache path -> HTTP status) refines rejected (413) year slices into
month slices and rejected month slices into reporter chunks. Landed files
make slices pending or done. No network I/O happens here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import chunk_array, month_token, request_url

CONFIG_SCHEMA = T.StructType([
    T.StructField("dataset_code", T.StringType()),
    T.StructField("base_url", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("frequency", T.StringType()),
    T.StructField("flow", T.ArrayType(T.StringType())),
    T.StructField("reporters", T.ArrayType(T.StringType())),
    T.StructField("reporter_chunk_size", T.LongType()),
    T.StructField("years", T.ArrayType(T.LongType())),
    T.StructField("months", T.ArrayType(T.LongType())),
    T.StructField("indicators", T.MapType(T.StringType(), T.StringType())),
    T.StructField("products", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
])

# Fixed value: HTTP status of a request rejected as too large.
TOO_LARGE = 413

SLICE_COLUMNS = [
    "dataset_code", "indicator_alias", "indicator_code", "product_group", "product_code", "year", "month",
    "reporter_chunk", "granularity", "times", "reporters", "cache_path", "request_url",
]
CONFIG_CARRY = ["base_url", "format", "frequency", "flow", "all_reporters", "reporter_chunk_size", "months"]


def read_request_config(spark: SparkSession, path: str) -> DataFrame:
    """Request config JSON file(s), one document per file."""
    return spark.read.schema(CONFIG_SCHEMA).option("multiLine", "true").json(path)


def _with_url(df: DataFrame) -> DataFrame:
    url = request_url(F.col("base_url"), F.col("dataset_code"), F.coalesce("format", F.lit("JSON")),
                      F.coalesce("frequency", F.lit("M")), F.coalesce("flow", F.array().cast("array<string>")),
                      F.col("reporters"), F.col("product_code"), F.col("indicator_code"), F.col("times"))
    return df.withColumn("request_url", url)


def chunk_id(position: Column) -> Column:
    """01, 02, ... 99, 100, ...: padded to two digits, never cut."""
    return F.format_string("%02d", position.cast("int") + 1)


def _path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def request_plan(config: DataFrame) -> DataFrame:
    """Indicator x product group x product x year slices (granularity ``year``)."""
    c = config.select(
        "dataset_code", "base_url", "format", "frequency", "flow",
        F.col("reporters").alias("all_reporters"), "reporter_chunk_size", "years", "months", "products",
        F.explode("indicators").alias("indicator_alias", "indicator_code"))
    c = c.select("*", F.explode("products").alias("product_group", "__codes")).drop("products")
    c = c.select("*", F.explode("__codes").alias("product_code")).drop("__codes")
    c = c.select("*", F.explode("years").alias("year")).drop("years")
    slices = c.select(
        "*",
        F.lit(None).cast("long").alias("month"),
        F.lit("all").alias("reporter_chunk"),
        F.lit("year").alias("granularity"),
        F.transform("months", lambda m: month_token(F.col("year"), m)).alias("times"),
        F.col("all_reporters").alias("reporters"),
        _path(F.col("dataset_code"), F.col("indicator_alias"), F.col("product_code"),
              F.concat(F.col("year").cast("string"), F.lit(".json"))).alias("cache_path"),
    )
    return _with_url(slices).select(*SLICE_COLUMNS, *CONFIG_CARRY)


def refine_plan(slices: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Replace rejected slices by their children, one level.

    ``outcomes``: ``cache_path, status_code``. A rejected year slice becomes
    one slice per configured month; a rejected month slice becomes reporter
    chunks of ``reporter_chunk_size`` (``<= 0``: one chunk) with ids ``01``,
    ``02`` ... . Other slices are kept as they are. One pass: each slice
    explodes into itself or its children.
    """
    o = outcomes.select("cache_path", F.col("status_code").alias("__status"))
    s = slices.join(o, "cache_path", "left")
    rejected = F.coalesce(F.col("__status") == F.lit(TOO_LARGE), F.lit(False))

    def child(month, granularity, chunk, reporters, times, path):
        return F.struct(month.cast("long").alias("month"), granularity.alias("granularity"),
                        chunk.alias("reporter_chunk"), reporters.alias("reporters"), times.alias("times"),
                        path.alias("cache_path"))

    def prefix():
        return [F.col("dataset_code"), F.col("indicator_alias"), F.col("product_code")]

    keep = F.array(child(F.col("month"), F.col("granularity"), F.col("reporter_chunk"), F.col("reporters"),
                         F.col("times"), F.col("cache_path")))
    months = F.transform("months", lambda m: child(
        m, F.lit("month"), F.lit("all"), F.col("all_reporters"), F.array(month_token(F.col("year"), m)),
        _path(*prefix(), F.concat(month_token(F.col("year"), m), F.lit(".json")))))
    chunks = F.transform(chunk_array("all_reporters", F.col("reporter_chunk_size")), lambda c, i: child(
        F.col("month"), F.lit("month_reporter_chunk"), chunk_id(i), c, F.col("times"),
        _path(*prefix(), F.concat(month_token(F.col("year"), F.col("month")), F.lit("_reporters_"),
                                  chunk_id(i), F.lit(".json")))))
    children = (F.when(rejected & (F.col("granularity") == F.lit("year")), months)
                 .when(rejected & (F.col("granularity") == F.lit("month")), chunks)
                 .otherwise(keep))
    carry = [c for c in SLICE_COLUMNS + CONFIG_CARRY
             if c not in ("month", "granularity", "reporter_chunk", "reporters", "times", "cache_path",
                          "request_url")]
    out = s.select(*carry, F.explode(children).alias("__c")).select(*carry, "__c.*")
    return _with_url(out).select(*SLICE_COLUMNS, *CONFIG_CARRY)


def pending_slices(plan: DataFrame, landed: DataFrame, force: bool = False) -> DataFrame:
    """Slices still to fetch: those without a landed file (all when ``force``).

    ``landed`` holds ``cache_path`` relative to the landing root.
    """
    if force:
        return plan
    return plan.join(landed.select("cache_path"), "cache_path", "left_anti")


def request_manifest(plan: DataFrame, cell_counts: DataFrame) -> DataFrame:
    """Slice statistics: the plan joined with the landed documents' counts.

    ``cell_counts``: ``cache_path, response_updated, cell_count, row_count``
    (see :func:`~tradeflow.operators.cube.cube_cell_counts`). Slices without a
    document keep null counts and ``success`` false. Landed documents that the
    plan does not name (earlier refinements) are listed too, with what their
    path says.
    """
    m = plan.join(cell_counts, "cache_path", "left")
    parts = F.split("cache_path", "/")
    name = F.regexp_replace(F.get(parts, F.lit(3)), r"\.json$", "")
    chunk = F.regexp_extract(name, r"_reporters_(.+)$", 1)
    unplanned = cell_counts.join(plan.select("cache_path"), "cache_path", "left_anti").select(
        "*", F.get(parts, F.lit(0)).alias("dataset_code"), F.get(parts, F.lit(1)).alias("indicator_alias"),
        F.get(parts, F.lit(2)).alias("product_code"),
        F.regexp_extract(name, r"^(\d{4})", 1).try_cast("long").alias("year"),
        F.regexp_extract(name, r"^\d{4}-(\d{2})", 1).try_cast("long").alias("month"),
        F.when(chunk != "", chunk).otherwise("all").alias("reporter_chunk"),
        F.when(chunk != "", "month_reporter_chunk").when(name.contains("-"), "month").otherwise("year").alias("granularity"))
    m = m.unionByName(unplanned, allowMissingColumns=True)
    landed = F.col("cell_count").isNotNull()
    return m.select(
        "dataset_code", "indicator_alias", "indicator_code", "product_group", "product_code",
        F.col("year").cast("string").alias("year"),
        F.coalesce(F.col("month").cast("string"), F.lit("")).alias("month"),
        "reporter_chunk", "granularity", "request_url", "cache_path",
        F.when(landed, F.lit("200")).alias("status_code"),
        landed.alias("success"),
        F.coalesce("response_updated", F.lit("")).alias("response_updated"),
        "cell_count", "row_count",
        F.date_trunc("second", F.current_timestamp()).alias("requested_at"),
    )


def probe_plan(spark: SparkSession, product_url: str, statistics_url: str, statistics_datasets: Sequence[str]) -> DataFrame:
    """Requests that ask each dataset for its latest period: rows (dataset_code,
    api_type, source_url). ``product_url`` is the whole request of the product
    dataset (type ``comext``); each of the others is ``statistics_url/<code>``
    (type ``statistics``)."""
    product = product_url.partition("?")[0].rstrip("/").rpartition("/")[2]
    rows = [(product, "comext", product_url)] + [
        (code, "statistics", f"{statistics_url.rstrip('/')}/{code}?format=JSON") for code in statistics_datasets]
    return spark.createDataFrame(rows, "dataset_code string, api_type string, source_url string")


MANIFEST_ORDER = ["indicator_alias", "product_group", "product_code", "year", "month", "reporter_chunk"]
