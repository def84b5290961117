"""Request-planning workloads: a config derived from the tables, refined by
outcomes derived from slice sizes.

Config: products = part type -> its brands, years = order years, reporters =
nation codes, chunks of 7 reporters. A year slice is rejected as too large
when its brand had more than ``YEAR_LIMIT`` lines shipped that year; a month
slice when more than ``MONTH_LIMIT`` lines that month.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import chunk_array
from ..plans.numbered import PlanLists, numbered_slices, positioned, refine_numbered, rejected_paths, with_urls
from ..plans.requests import TOO_LARGE, chunk_id, pending_slices, refine_plan, request_manifest, request_plan
from .tables import table

# Fixed values of the workload config.
DATASET = "star"
BASE_URL = "https://stats.example.org/api/data/"
CHUNK = 7
YEAR_LIMIT = 300
MONTH_LIMIT = 40
MONTHS = list(range(1, 13))


def star_config(spark: SparkSession, sf: str) -> DataFrame:
    """One config row; every list comes from the tables in one aggregation."""
    part = table(spark, sf, "part").select(F.lit("product").alias("kind"), F.col("p_type").alias("k"),
                                           F.col("p_brand").alias("v"))
    years = table(spark, sf, "orders").select(F.lit("year").alias("kind"), F.lit("").alias("k"),
                                              F.year("o_orderdate").cast("string").alias("v"))
    reps = table(spark, sf, "nation").select(F.lit("reporter").alias("kind"), F.lit("").alias("k"),
                                             F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("v"))
    lists = (part.unionByName(years).unionByName(reps).distinct()
             .groupBy("kind", "k").agg(F.array_sort(F.collect_list("v")).alias("vs")))
    cfg = lists.agg(
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == "product", F.struct("k", "vs")))).alias("products"),
        F.max(F.when(F.col("kind") == "year", F.col("vs"))).alias("years"),
        F.max(F.when(F.col("kind") == "reporter", F.col("vs"))).alias("reporters"),
    )
    return cfg.select(
        F.lit(DATASET).alias("dataset_code"), F.lit(BASE_URL).alias("base_url"), F.lit("JSON").alias("format"),
        F.lit("M").alias("frequency"), F.array(F.lit("1")).alias("flow"), "reporters",
        F.lit(CHUNK).cast("long").alias("reporter_chunk_size"),
        F.transform("years", lambda y: y.cast("long")).alias("years"),
        F.array(*[F.lit(m).cast("long") for m in MONTHS]).alias("months"),
        F.create_map(F.lit("value"), F.lit("VALUE_IN_EUROS"), F.lit("weight"), F.lit("QUANTITY_IN_100KG"))
        .alias("indicators"),
        "products",
    )


def slice_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """cache_path -> status: 413 for slices over the size limits, else 200."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate").join(
        table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    per_month = lines.groupBy("p_brand", F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m")).agg(
        F.count(F.lit(1)).alias("n"))
    per_year = per_month.groupBy("p_brand", "y").agg(F.sum("n").alias("n"))
    aliases = F.explode(F.array(F.lit("value"), F.lit("weight"))).alias("alias")
    year_paths = per_year.select(
        aliases, "p_brand", "y", F.when(F.col("n") > YEAR_LIMIT, F.lit(TOO_LARGE)).otherwise(F.lit(200))
        .alias("status_code")).select(
        F.concat_ws("/", F.lit(DATASET), "alias", "p_brand", F.concat(F.col("y").cast("string"), F.lit(".json")))
        .alias("cache_path"), "status_code")
    month_paths = per_month.select(
        aliases, "p_brand", "y", "m", F.when(F.col("n") > MONTH_LIMIT, F.lit(TOO_LARGE)).otherwise(F.lit(200))
        .alias("status_code")).select(
        F.concat_ws("/", F.lit(DATASET), "alias", "p_brand",
                    F.concat(F.format_string("%04d-%02d", "y", "m"), F.lit(".json"))).alias("cache_path"),
        "status_code")
    return year_paths.unionByName(month_paths)


_OUT = ["indicator_alias", "product_group", "product_code", "year", "month", "reporter_chunk", "granularity",
        "cache_path", "request_url"]


def request_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Year-level request plan with URLs."""
    return request_plan(star_config(spark, sf)).select(*_OUT)


def refined_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Plan after two refinement rounds (year -> months -> reporter chunks)."""
    outcomes = slice_outcomes(spark, sf)
    plan = request_plan(star_config(spark, sf))
    plan = refine_plan(plan, outcomes)
    plan = refine_plan(plan, outcomes)
    return plan.select(*_OUT, F.size("reporters").alias("n_reporters"))


def pending_year_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Year slices still to fetch: the plan minus the slices that landed (status 200)."""
    landed = slice_outcomes(spark, sf).where(F.col("status_code") == 200).select("cache_path")
    return pending_slices(request_plan(star_config(spark, sf)), landed).select(*_OUT)


def landed_cell_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Cell counts of the landed year slices: distinct (partner, month) cells of
    a brand-year on each indicator's side (value: not flagged N; weight: status F)."""
    lines = (table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", "l_returnflag",
                                                 "l_linestatus")
             .join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
             .join(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"),
                   "l_suppkey"))
    sides = F.explode(F.array(
        F.struct(F.lit("value").alias("alias"), (F.col("l_returnflag") != F.lit("N")).alias("on")),
        F.struct(F.lit("weight").alias("alias"), (F.col("l_linestatus") == F.lit("F")).alias("on"))))
    cells = (lines.select("p_brand", F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"),
                          "s_nationkey", sides.alias("s"))
             .where(F.col("s.on"))
             .groupBy(F.col("s.alias").alias("alias"), "p_brand", "y")
             .agg(F.count_distinct("m", "s_nationkey").alias("cell_count")))
    counts = cells.select(
        F.concat_ws("/", F.lit(DATASET), "alias", "p_brand", F.concat(F.col("y").cast("string"), F.lit(".json")))
        .alias("cache_path"),
        F.concat((F.col("y") + 1).cast("string"), F.lit("-02-01T00:00:00+0000")).alias("response_updated"),
        F.col("cell_count").cast("long").alias("cell_count"), F.col("cell_count").cast("long").alias("row_count"))
    landed = slice_outcomes(spark, sf).where(F.col("status_code") == 200).select("cache_path")
    return counts.join(landed, "cache_path", "left_semi")


def request_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Request manifest of the year plan: landed slices with their cell counts."""
    manifest = request_manifest(request_plan(star_config(spark, sf)), landed_cell_counts(spark, sf))
    return manifest.drop("requested_at")


def chunk_brands(spark: SparkSession, sf: str) -> DataFrame:
    """Brands of each part type in chunks of 4, chunk ids 01, 02 ..."""
    brands = table(spark, sf, "part").select("p_type", "p_brand").distinct().groupBy("p_type").agg(
        F.array_sort(F.collect_list("p_brand")).alias("brands"))
    return brands.select("p_type", F.posexplode(chunk_array("brands", F.lit(4))).alias("i", "chunk")).select(
        "p_type", chunk_id(F.col("i")).alias("chunk_id"),
        F.array_join("chunk", ",").alias("brands"))


def star_lists(spark: SparkSession, sf: str) -> PlanLists:
    """The lists of the star config as tables with positions."""
    part = table(spark, sf, "part").select(F.col("p_type").alias("product_group"), F.col("p_brand").alias("product_code")).distinct()
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    reporters = table(spark, sf, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("reporter"))
    indicators = dims.small_table(spark, [(0, "value", "VALUE_IN_EUROS"), (1, "weight", "QUANTITY_IN_100KG")],
                                  "pos long, indicator_alias string, indicator_code string")
    return PlanLists(DATASET, BASE_URL, indicators, positioned(part, ["product_group", "product_code"]), positioned(years, ["year"]),
                     positioned(reporters, ["reporter"]), CHUNK, MONTHS, ("1",))


def numbered_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The plan after two rounds of refinement, made from slice numbers."""
    lists, rejected = star_lists(spark, sf), rejected_paths(slice_outcomes(spark, sf))
    plan = numbered_slices(spark, lists)
    for _ in range(2):
        plan = refine_numbered(plan, rejected, lists)
    return with_urls(plan, lists).select(*_OUT, F.size("reporters").alias("n_reporters"))


def many_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """A plan with a chunk for each supplier: more than 99 of them. Products are
    the part types, the only month is January and every slice is too large."""
    suppliers = table(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("reporter"))
    types = table(spark, sf, "part").select(F.col("p_type").alias("product_group"), F.col("p_type").alias("product_code")).distinct()
    lists = replace(star_lists(spark, sf), reporters=positioned(suppliers, ["reporter"]), chunk_size=1, months=[1],
                    products=positioned(types, ["product_code"]),
                    indicators=dims.small_table(spark, [(0, "value", "VALUE_IN_EUROS")],
                                                "pos long, indicator_alias string, indicator_code string"))
    plan = numbered_slices(spark, lists)
    for _ in range(2):
        plan = refine_numbered(plan, plan, lists)
    return plan.select("product_code", "year", "month", "reporter_chunk", "granularity", "cache_path",
                       F.array_join("reporters", ",").alias("reporters"))


_BASE_SQL = f"""
WITH prod AS (SELECT DISTINCT p_type AS product_group, p_brand AS product_code FROM part),
yrs AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS year FROM orders),
ind(indicator_alias, indicator_code) AS (VALUES ('value', 'VALUE_IN_EUROS'), ('weight', 'QUANTITY_IN_100KG')),
rep AS (SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS code,
               row_number() OVER (ORDER BY 'N' || CAST(n_nationkey AS VARCHAR)) - 1 AS i FROM nation),
allrep AS (SELECT string_agg('reporter=' || code, '&' ORDER BY code) AS q, CAST(count(*) AS INTEGER) AS n
           FROM rep),
mon AS (SELECT unnest(generate_series(1, 12)) AS month),
yq AS (SELECT year, string_agg('time=' || CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0'),
                               '&' ORDER BY month) AS tq FROM yrs, mon GROUP BY year),
base AS (
  SELECT ind.indicator_alias, ind.indicator_code, prod.product_group, prod.product_code, yrs.year
  FROM ind CROSS JOIN prod CROSS JOIN yrs),
lines AS (SELECT p.p_brand, CAST(year(l.l_shipdate) AS BIGINT) AS y, CAST(month(l.l_shipdate) AS BIGINT) AS m,
                 count(*) AS n
          FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY ALL),
ylines AS (SELECT p_brand, y, sum(n) AS n FROM lines GROUP BY ALL)"""


def _url(reporters: str, times: str) -> str:
    return (f"'{BASE_URL.rstrip('/')}/{DATASET}?format=JSON&freq=M&flow=1&' || {reporters} || "
            f"'&product=' || url_encode(product_code) || '&indicators=' || indicator_code || '&' || {times}")


SQL = {
    "request_slices": _BASE_SQL + f"""
SELECT indicator_alias, product_group, product_code, year, CAST(NULL AS BIGINT) AS month, 'all' AS reporter_chunk,
       'year' AS granularity,
       '{DATASET}/' || indicator_alias || '/' || product_code || '/' || CAST(year AS VARCHAR) || '.json' AS cache_path,
       {_url('allrep.q', 'yq.tq')} AS request_url
FROM base JOIN yq USING (year), allrep""",
    "refined_slices": _BASE_SQL + f""",
yslice AS (
  SELECT b.*, coalesce(yl.n, 0) > {YEAR_LIMIT} AS rejected FROM base b
  LEFT JOIN ylines yl ON yl.p_brand = b.product_code AND yl.y = b.year),
mslice AS (
  SELECT y.indicator_alias, y.indicator_code, y.product_group, y.product_code, y.year, mon.month,
         coalesce(l.n, 0) > {MONTH_LIMIT} AS rejected
  FROM yslice y CROSS JOIN mon
  LEFT JOIN lines l ON l.p_brand = y.product_code AND l.y = y.year AND l.m = mon.month
  WHERE y.rejected),
chunks AS (SELECT i // {CHUNK} AS c, string_agg('reporter=' || code, '&' ORDER BY code) AS q,
                  CAST(count(*) AS INTEGER) AS n
           FROM rep GROUP BY 1)
SELECT indicator_alias, product_group, product_code, year, CAST(NULL AS BIGINT) AS month, 'all' AS reporter_chunk,
       'year' AS granularity,
       '{DATASET}/' || indicator_alias || '/' || product_code || '/' || CAST(year AS VARCHAR) || '.json' AS cache_path,
       {_url('allrep.q', 'yq.tq')} AS request_url, allrep.n AS n_reporters
FROM yslice JOIN yq USING (year), allrep WHERE NOT rejected
UNION ALL
SELECT indicator_alias, product_group, product_code, year, month, 'all', 'month',
       '{DATASET}/' || indicator_alias || '/' || product_code || '/' || CAST(year AS VARCHAR) || '-'
         || lpad(CAST(month AS VARCHAR), 2, '0') || '.json',
       {_url('allrep.q', "'time=' || CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0')")},
       allrep.n
FROM mslice, allrep WHERE NOT rejected
UNION ALL
SELECT indicator_alias, product_group, product_code, year, month, printf('%02d', c + 1),
       'month_reporter_chunk',
       '{DATASET}/' || indicator_alias || '/' || product_code || '/' || CAST(year AS VARCHAR) || '-'
         || lpad(CAST(month AS VARCHAR), 2, '0') || '_reporters_' || printf('%02d', c + 1) || '.json',
       {_url('chunks.q', "'time=' || CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0')")},
       chunks.n
FROM mslice CROSS JOIN chunks WHERE rejected""",
    "pending_year_slices": _BASE_SQL + f"""
SELECT indicator_alias, product_group, product_code, year, CAST(NULL AS BIGINT) AS month, 'all' AS reporter_chunk,
       'year' AS granularity,
       '{DATASET}/' || indicator_alias || '/' || product_code || '/' || CAST(year AS VARCHAR) || '.json' AS cache_path,
       {_url('allrep.q', 'yq.tq')} AS request_url
FROM base JOIN yq USING (year)
LEFT JOIN ylines yl ON yl.p_brand = base.product_code AND yl.y = base.year, allrep
WHERE yl.n > {YEAR_LIMIT} OR yl.n IS NULL""",
    "request_stats": _BASE_SQL + f""",
cells AS (
  SELECT a.alias, p.p_brand, CAST(year(l.l_shipdate) AS BIGINT) AS y,
         count(DISTINCT (month(l.l_shipdate), s.s_nationkey)) AS cell_count
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN (VALUES ('value'), ('weight')) AS a(alias)
    ON (a.alias = 'value' AND l.l_returnflag <> 'N') OR (a.alias = 'weight' AND l.l_linestatus = 'F')
  GROUP BY ALL),
landed AS (
  SELECT b.indicator_alias AS l_alias, b.product_group AS l_group, b.product_code AS l_code, b.year AS l_year,
         c.cell_count FROM base b
  LEFT JOIN ylines yl ON yl.p_brand = b.product_code AND yl.y = b.year
  LEFT JOIN cells c ON c.alias = b.indicator_alias AND c.p_brand = b.product_code AND c.y = b.year
  WHERE coalesce(yl.n, 0) <= {YEAR_LIMIT} AND c.cell_count IS NOT NULL)
SELECT b.indicator_alias, b.indicator_code, b.product_group, b.product_code, '{DATASET}' AS dataset_code,
       CAST(b.year AS VARCHAR) AS year, '' AS month, 'all' AS reporter_chunk, 'year' AS granularity,
       {_url('allrep.q', 'yq.tq')} AS request_url,
       '{DATASET}/' || b.indicator_alias || '/' || b.product_code || '/' || CAST(b.year AS VARCHAR) || '.json'
         AS cache_path,
       CASE WHEN l.cell_count IS NOT NULL THEN '200' END AS status_code, l.cell_count IS NOT NULL AS success,
       CASE WHEN l.cell_count IS NOT NULL THEN CAST(b.year + 1 AS VARCHAR) || '-02-01T00:00:00+0000' ELSE '' END
         AS response_updated,
       l.cell_count, l.cell_count AS row_count
FROM base b JOIN yq USING (year) CROSS JOIN allrep
LEFT JOIN landed l ON l.l_alias = b.indicator_alias AND l.l_group = b.product_group
  AND l.l_code = b.product_code AND l.l_year = b.year""",
    "many_chunks": f"""
WITH types AS (SELECT DISTINCT p_type FROM part),
yrs AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS year FROM orders),
sup AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS code,
               printf('%02d', row_number() OVER (ORDER BY 'S' || CAST(s_suppkey AS VARCHAR))) AS id FROM supplier)
SELECT p_type AS product_code, year, CAST(1 AS BIGINT) AS month, id AS reporter_chunk,
       'month_reporter_chunk' AS granularity,
       '{DATASET}/value/' || p_type || '/' || CAST(year AS VARCHAR) || '-01_reporters_' || id || '.json' AS cache_path,
       code AS reporters
FROM types, yrs, sup""",
    "chunk_brands": """
SELECT p_type, printf('%02d', i // 4 + 1) AS chunk_id, string_agg(p_brand, ',' ORDER BY p_brand) AS brands
FROM (SELECT p_type, p_brand, row_number() OVER (PARTITION BY p_type ORDER BY p_brand) - 1 AS i
      FROM (SELECT DISTINCT p_type, p_brand FROM part))
GROUP BY p_type, i // 4""",
}

SQL["numbered_plan"] = SQL["refined_slices"]

QUERIES = {
    "request_slices": request_slices,
    "refined_slices": refined_slices,
    "pending_year_slices": pending_year_slices,
    "request_stats": request_stats,
    "many_chunks": many_chunks,
    "numbered_plan": numbered_plan,
    "chunk_brands": chunk_brands,
}
