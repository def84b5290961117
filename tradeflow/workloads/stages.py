"""Workloads that go through files: stage tables, caches, manifests and the
published export are written to the checkpoint folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import iso_date
from ..jobs.stages import MERGED_COLUMNS, PUBLISH_ORDER, merged_rows
from ..operators import tag
from ..operators.increment import MANIFEST_ORDER, MANIFEST_SCHEMA, diff_sources, next_manifest
from ..operators.ordering import ordered
from ..session import checkpoint_dir
from ..sinks.tables import export_sorted, overwrite_years, write_partitions, write_versioned
from ..sources.stage import distinct_years, read_manifest, read_stage, read_years
from .increment import _listing, _manifest, _supplier_years
from .star import _MERGED_SQL, EXACT, star_facts, star_partner_dim, star_product_dim
from .tables import table

# Restated years, the year that loses its rows, the last year
# that the stage of the fallback workload holds.
RESTATED, EMPTIED, LAST_HELD = (1995, 1996), 1997, 1995


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/workloads/{name}-{uuid.uuid4().hex}"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), F.year("l_shipdate").alias("year"), "l_returnflag",
        F.col("l_orderkey").cast("string").alias("hs_code"), F.col("l_extendedprice").cast(EXACT).alias("value"))


def year_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """Write all years, restate two, empty one; what the table then holds."""
    lines, path = _lines(spark, sf), _folder(spark, "years")
    overwrite_years(spark, lines, path, sort_within=["hs_code"], numeric=["hs_code"])
    again = lines.where(F.col("year").isin(*RESTATED)).withColumn("value", (F.col("value") * 2).cast(EXACT))
    overwrite_years(spark, again, path, empty_years=[EMPTIED], sort_within=["hs_code"], numeric=["hs_code"])
    return read_stage(spark, path).groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("value"))


def stage_cache(spark: SparkSession, sf: str) -> DataFrame:
    """A cache by (source, year); one source is read again without its last year."""
    lines, path = _lines(spark, sf).withColumnRenamed("l_returnflag", "source_id"), _folder(spark, "cache")
    write_partitions(lines, path, ["source_id", "year"])
    again = lines.where((F.col("source_id") == "R") & (F.col("year") < EMPTIED))
    write_partitions(again.withColumn("value", -F.col("value")), path, ["source_id", "year"])
    return spark.read.parquet(path).groupBy("source_id", F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("value"))


def read_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Years of a stage that holds the early ones; the combined table has the rest."""
    lines, path = _lines(spark, sf).drop("l_returnflag"), _folder(spark, "held")
    overwrite_years(spark, lines.where(F.col("year") <= LAST_HELD), path)
    combined = lines.drop("year").withColumn("value", (F.col("value") + 1).cast(EXACT))
    years = distinct_years(lines)
    found = read_years(spark, path, f"date date, hs_code string, value {EXACT}, year int", years, combined)
    return found.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("value"))


def merge_stages(spark: SparkSession, sf: str) -> DataFrame:
    """The stage jobs' merge over four stage tables, published as the sorted export."""
    held = _folder(spark, "merge-facts")
    # Joined once: each of the four stages below reads its lines from here.
    (star_facts(spark, sf).join(star_product_dim(spark).drop("keep"), "product")
     .select("type", "country", "date", "product", "partner", "hs_code", "category", "general_category",
             "l_returnflag", "l_linestatus", "l_extendedprice", "l_quantity")
     .write.parquet(held))
    facts = spark.read.parquet(held)
    stages = {}
    for module in ("tyre", "vehicle"):
        own = facts.where(F.lower("type") == module)
        for measure, kept, amount in (("value", F.col("l_returnflag") != "N", "l_extendedprice"),
                                      ("weight", F.col("l_linestatus") == "F", "l_quantity")):
            category = ["category"] if module == "tyre" else []
            rows = tag(own.where(kept), indicator=measure).select(
                "country", "date", "product", "indicator", "partner", F.col(amount).cast(EXACT).alias(measure),
                F.year("date").alias("year"), "hs_code", *category, "general_category")
            path = _folder(spark, f"{module}-{measure}")
            overwrite_years(spark, rows, path)
            stages[module, measure] = read_stage(spark, path)
    rows = merged_rows(*stages.values(), star_partner_dim(spark, sf), floor="1997-01-01")
    path = _folder(spark, "export")
    export_sorted(rows.withColumn("date", iso_date("date")), path, PUBLISH_ORDER, numeric=["hs_code"])
    return spark.read.parquet(path).select(*[
        F.col(c).cast("double") if c in ("value", "weight") else F.col(c) for c in MERGED_COLUMNS])


def manifest_next(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest after a run over the suppliers' files, as read back."""
    manifest = _manifest(spark, sf).select(
        F.lit("lines").alias("module"), F.lit("value").alias("measure"), "source_name", "source_path", "fingerprint",
        F.lit(0).cast("long").alias("size_bytes"), F.lit(None).cast("timestamp").alias("mtime"), "source_id",
        "years", F.lit(None).cast("date").alias("min_date"), F.lit(None).cast("date").alias("max_date"),
        F.lit(-1).cast("long").alias("row_count"), "active", F.lit(None).cast("timestamp").alias("updated_at"))
    other = tag(manifest.limit(1), module="other")
    kept = manifest.unionByName(other).select(*MANIFEST_SCHEMA.names)
    diff = diff_sources(_listing(spark, sf), manifest)
    after = next_manifest(kept, diff, _supplier_years(spark, sf, only_f=False), "lines", "value", F.col("source_path"))
    root = _folder(spark, "manifest")
    write_versioned(ordered(kept, MANIFEST_ORDER), root, "1")
    write_versioned(ordered(after, MANIFEST_ORDER), root, "2")
    return read_manifest(spark, root).where("module = 'lines'").select("source_path", "active", "row_count")


SQL = {
    "year_rewrite": f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN year(l_shipdate) IN {RESTATED} THEN 2 ELSE 1 END)
            AS DOUBLE) AS value
FROM lineitem WHERE year(l_shipdate) <> {EMPTIED} GROUP BY 1""",
    "stage_cache": f"""
SELECT l_returnflag AS source_id, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))
                * CASE WHEN l_returnflag = 'R' AND year(l_shipdate) < {EMPTIED} THEN -1 ELSE 1 END) AS DOUBLE) AS value
FROM lineitem GROUP BY 1, 2""",
    "read_fallback": f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) + CASE WHEN year(l_shipdate) > {LAST_HELD} THEN 1 ELSE 0 END)
            AS DOUBLE) AS value
FROM lineitem GROUP BY 1""",
    "merge_stages": f"SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM ({_MERGED_SQL})",
    "manifest_next": """
WITH s AS (
  SELECT 'landing/supplier_' || CAST(s_suppkey AS VARCHAR) || '.xlsx' AS source_path, s_acctbal >= 0 AS listed,
         s_nationkey <> 1 AS known, s_nationkey = 2 AS was_off, s_acctbal > 5000 AS changed,
         (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey) AS n
  FROM supplier)
SELECT source_path, listed AS active,
       CASE WHEN listed AND (NOT known OR was_off OR changed) THEN n ELSE -1 END AS row_count
FROM s WHERE listed OR known""",
}

QUERIES = {"year_rewrite": year_rewrite, "stage_cache": stage_cache, "read_fallback": read_fallback,
           "merge_stages": merge_stages, "manifest_next": manifest_next}
