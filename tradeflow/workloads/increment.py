"""Incremental-maintenance workloads on the star tables.

Sources are suppliers: a supplier's file holds its line items. The previous
manifest knows suppliers outside nation 1 (those are new), marks suppliers of
nation 2 inactive (listed again: restored), and recorded the years of the
supplier's F-status lines. The current listing drops suppliers with a
negative balance (removed) and changes the fingerprint of balances over 5000.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..operators import keep_latest
from ..operators.increment import affected_years, diff_sources, profile_sources
from ..session import checkpoint_dir
from ..sinks.buckets import Bucketed, bucketed_table, buckets_for, write_bucketed
from .tables import table


def _path(key: str) -> F.Column:
    return F.concat(F.lit("landing/supplier_"), F.col(key).cast("string"), F.lit(".xlsx"))


def source_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as one source per return flag: years, dates, row counts."""
    li = table(spark, sf, "lineitem").select(
        F.concat(F.lit("returns_"), F.col("l_returnflag"), F.lit(".xlsx")).alias("source_name"),
        F.col("l_shipdate").cast("date").alias("date"))
    return profile_sources(li, "source_name", "date").select(
        "source_name", "years_text", "min_date", "max_date", "row_count")


def _supplier_years(spark: SparkSession, sf: str, only_f: bool) -> DataFrame:
    li = table(spark, sf, "lineitem")
    if only_f:
        li = li.where(F.col("l_linestatus") == F.lit("F"))
    li = li.select(_path("l_suppkey").alias("source_path"), F.col("l_shipdate").cast("date").alias("date"))
    return profile_sources(li, "source_path", "date")


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    sup = table(spark, sf, "supplier").where(F.col("s_acctbal") >= 0)
    fp = F.when(F.col("s_acctbal") > 5000, F.concat(F.col("s_acctbal").cast("string"), F.lit("*"))).otherwise(
        F.col("s_acctbal").cast("string"))
    return sup.select(_path("s_suppkey").alias("source_path"),
                      F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string"), F.lit(".xlsx"))
                      .alias("source_name"),
                      fp.alias("fingerprint"), F.lit(0).cast("long").alias("size_bytes"),
                      F.lit(None).cast("timestamp").alias("mtime"))


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    sup = table(spark, sf, "supplier").where(F.col("s_nationkey") != 1)
    prev_years = _supplier_years(spark, sf, only_f=True).select("source_path", "years")
    return (sup.select(_path("s_suppkey").alias("source_path"),
                       F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string"), F.lit(".xlsx"))
                       .alias("source_name"),
                       F.col("s_acctbal").cast("string").alias("fingerprint"),
                       (F.col("s_nationkey") != 2).alias("active"),
                       F.col("s_suppkey").cast("string").alias("source_id"))
            .join(prev_years, "source_path", "left"))


def source_diff(spark: SparkSession, sf: str) -> DataFrame:
    """State and refresh flag per source path."""
    d = diff_sources(_listing(spark, sf), _manifest(spark, sf))
    return d.select("source_path", "state", "refresh")


def affected_years_q(spark: SparkSession, sf: str) -> DataFrame:
    """Years to rebuild after the diff."""
    d = diff_sources(_listing(spark, sf), _manifest(spark, sf))
    return affected_years(d, _supplier_years(spark, sf, only_f=False)).select(F.col("year").cast("int"))


def _snapshot(spark: SparkSession, sf: str, name: str, mtime: str, restated: bool) -> DataFrame:
    li = table(spark, sf, "lineitem")
    value = F.col("l_extendedprice").cast("decimal(18,2)")
    if restated:
        li, value = li.where(F.col("l_returnflag") == F.lit("R")), value * 2
    return li.select(F.lit(f"landing/{name}").alias("source_path"), F.lit(name).alias("source_name"),
                     F.lit(mtime).cast("timestamp").alias("source_mtime"), "l_orderkey", "l_linenumber",
                     "l_shipdate", "l_suppkey", "l_partkey", F.col("l_shipdate").cast("date").alias("date"),
                     F.year("l_shipdate").alias("year"), value.alias("value"))


def stage_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as two overlapping sources; the second (a later restatement of
    R-flagged lines) is new. Rebuild the affected years: latest file wins per
    (year, order, line)."""
    v1 = _snapshot(spark, sf, "lines_v1.xlsx", "2024-01-01 00:00:00", restated=False)
    v2 = _snapshot(spark, sf, "lines_v2.xlsx", "2024-02-01 00:00:00", restated=True)
    cache = v1.unionByName(v2)
    listing = dims.small_table(spark, [("landing/lines_v1.xlsx", "lines_v1.xlsx", "1"),
                                       ("landing/lines_v2.xlsx", "lines_v2.xlsx", "2")],
                               "source_path string, source_name string, fingerprint string").select(
        "*", F.lit(0).cast("long").alias("size_bytes"), F.lit(None).cast("timestamp").alias("mtime"))
    manifest = profile_sources(v1, "source_path", "date").select(
        "source_path", F.lit("lines_v1.xlsx").alias("source_name"), F.lit("1").alias("fingerprint"),
        "years", F.lit(True).alias("active"), F.lit("v1").alias("source_id"))
    diff = diff_sources(listing, manifest)
    # Calendar years: a bounded list that prunes the scan, as in the stage job.
    years = [r.year for r in affected_years(diff, profile_sources(cache, "source_path", "date")).collect()]
    rebuilt = keep_latest(cache.where(F.col("year").isin(years)), ["year", "l_orderkey", "l_linenumber"],
                          ["source_mtime", "source_name", "l_shipdate", "l_suppkey", "l_partkey"])
    return rebuilt.select(F.col("year").cast("int"), "l_orderkey", "l_linenumber",
                          F.col("value").cast("double").alias("value"), "source_name")


def bucketed_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """The same rebuild from caches in buckets of the business key: the latest
    rows are chosen where the buckets lie."""
    years = [r.year for r in table(spark, sf, "lineitem").where(F.col("l_returnflag") == F.lit("R"))
             .select(F.year("l_shipdate").alias("year")).distinct().collect()]
    rebuilt = keep_latest(_bucketed_snapshots(spark, sf).where(F.col("year").isin(years)),
                          ["year", "l_orderkey", "l_linenumber"],
                          ["source_mtime", "source_name", "l_shipdate", "l_suppkey", "l_partkey"])
    return rebuilt.select(F.col("year").cast("int"), "l_orderkey", "l_linenumber",
                          F.col("value").cast("double").alias("value"), "source_name")


def _bucketed_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Both snapshots in one cache, written one after the other; it has as many
    buckets as the lines need."""
    buckets = buckets_for(table(spark, sf, "lineitem").count())
    name = f"snapshots_{uuid.uuid4().hex}"
    cache = Bucketed(name, f"{checkpoint_dir(spark).rstrip('/')}/workloads/{name}",
                     "l_orderkey bigint, l_linenumber int, l_shipdate timestamp_ntz, l_suppkey bigint, l_partkey bigint, "
                     "value decimal(18,2), source_name string, source_mtime timestamp, source_id string, year int",
                     ("source_id", "year"), ("l_orderkey", "l_linenumber"), buckets)
    for version, mtime, restated in (("v1", "2024-01-01 00:00:00", False), ("v2", "2024-02-01 00:00:00", True)):
        rows = _snapshot(spark, sf, f"lines_{version}.xlsx", mtime, restated)
        write_bucketed(rows.withColumn("source_id", F.lit(version)), cache)
    return bucketed_table(spark, cache)


_DIFF_SQL = """
WITH listing AS (
  SELECT 'landing/supplier_' || CAST(s_suppkey AS VARCHAR) || '.xlsx' AS source_path,
         CASE WHEN s_acctbal > 5000 THEN 'x' || CAST(s_acctbal AS VARCHAR) ELSE CAST(s_acctbal AS VARCHAR) END AS fp
  FROM supplier WHERE s_acctbal >= 0),
manifest AS (
  SELECT 'landing/supplier_' || CAST(s_suppkey AS VARCHAR) || '.xlsx' AS source_path,
         CAST(s_acctbal AS VARCHAR) AS fp, s_nationkey <> 2 AS active
  FROM supplier WHERE s_nationkey <> 1),
d AS (
  SELECT coalesce(l.source_path, m.source_path) AS source_path,
         CASE WHEN l.source_path IS NOT NULL AND m.source_path IS NULL THEN 'new'
              WHEN l.source_path IS NOT NULL AND NOT m.active THEN 'restored'
              WHEN l.source_path IS NOT NULL AND l.fp <> m.fp THEN 'changed'
              WHEN l.source_path IS NOT NULL THEN 'unchanged'
              WHEN m.active THEN 'removed' ELSE 'gone' END AS state
  FROM listing l FULL JOIN manifest m ON l.source_path = m.source_path)"""

SQL = {
    "source_profile": """
SELECT 'returns_' || l_returnflag || '.xlsx' AS source_name,
       string_agg(DISTINCT CAST(year(l_shipdate) AS VARCHAR), '|' ORDER BY CAST(year(l_shipdate) AS VARCHAR))
         AS years_text,
       CAST(min(l_shipdate) AS DATE) AS min_date, CAST(max(l_shipdate) AS DATE) AS max_date, count(*) AS row_count
FROM lineitem GROUP BY l_returnflag""",
    "source_diff": _DIFF_SQL + """
SELECT source_path, state, state IN ('new', 'changed', 'restored') AS refresh FROM d""",
    "affected_years": _DIFF_SQL + """,
ly AS (SELECT DISTINCT 'landing/supplier_' || CAST(l_suppkey AS VARCHAR) || '.xlsx' AS source_path,
              CAST(year(l_shipdate) AS INTEGER) AS year, l_linestatus = 'F' AS is_f FROM lineitem)
SELECT DISTINCT ly.year FROM d JOIN ly USING (source_path)
WHERE (d.state IN ('new', 'changed', 'restored'))
   OR (d.state = 'removed' AND ly.is_f)""",
}

SQL["stage_rebuild"] = """
WITH src AS (
  SELECT 'lines_v1.xlsx' AS source_name, 1 AS mtime, l_orderkey, l_linenumber, l_shipdate, l_suppkey, l_partkey,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS value FROM lineitem
  UNION ALL
  SELECT 'lines_v2.xlsx', 2, l_orderkey, l_linenumber, l_shipdate, l_suppkey, l_partkey,
         CAST(l_extendedprice AS DECIMAL(18,2)) * 2 FROM lineitem WHERE l_returnflag = 'R'),
yrs AS (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem WHERE l_returnflag = 'R')
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_orderkey, l_linenumber, CAST(value AS DOUBLE) AS value,
       source_name
FROM src WHERE year(l_shipdate) IN (SELECT y FROM yrs)
QUALIFY row_number() OVER (PARTITION BY year(l_shipdate), l_orderkey, l_linenumber
    ORDER BY mtime DESC, source_name DESC, l_shipdate DESC, l_suppkey DESC, l_partkey DESC) = 1"""

SQL["bucketed_rebuild"] = SQL["stage_rebuild"]

QUERIES = {
    "bucketed_rebuild": bucketed_rebuild,
    "source_profile": source_profile,
    "source_diff": source_diff,
    "affected_years": affected_years_q,
    "stage_rebuild": stage_rebuild,
}
