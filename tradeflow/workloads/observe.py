"""Workloads that observe what others only pass through: the whole manifest in
its stored order, lenient dates, single sums, composed dictionaries, request
configs as files and documents without periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import parse_date
from ..operators import compose_dims, lookup, pad_columns, sum_measure, tag
from ..operators.cube import latest_period
from ..operators.increment import MANIFEST_ORDER, MANIFEST_SCHEMA, diff_sources, next_manifest
from ..operators.ordering import ordered
from ..plans.requests import read_request_config, refine_plan, request_plan
from ..sinks.tables import write_versioned
from ..sources.cubes import parse_cubes
from .cubes import star_texts
from .increment import _listing, _manifest, _supplier_years
from .jobs import _stored
from .plans import _OUT, SQL as PLAN_SQL
from .plans import slice_outcomes, star_config
from .stages import _folder
from .star import CHAIN_PRODUCTS, EXACT, _line_products
from .tables import table


def manifest_stages(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest of two stages after a run of one of them, column-complete, in
    its stored order: the other stage's rows are as they were."""
    stage = _manifest(spark, sf).select(
        F.lit("lines").alias("module"), F.lit("value").alias("measure"), "source_name", "source_path", "fingerprint",
        F.lit(0).cast("long").alias("size_bytes"), F.lit(None).cast("timestamp").alias("mtime"), "source_id",
        "years", F.lit(None).cast("date").alias("min_date"), F.lit(None).cast("date").alias("max_date"),
        F.lit(-1).cast("long").alias("row_count"), "active", F.lit(None).cast("timestamp").alias("updated_at"))
    before = stage.unionByName(tag(stage, module="cells")).select(*MANIFEST_SCHEMA.names)
    after = next_manifest(before, diff_sources(_listing(spark, sf), stage), _supplier_years(spark, sf, only_f=False),
                          "lines", "value", F.col("source_path"))
    path = write_versioned(ordered(after, MANIFEST_ORDER), _folder(spark, "manifest-stages"), "1")
    return pad_columns(_stored(spark, path), ["module", "source_path", "active", "row_count", "note", "place"])


def lenient_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates written in five ways, parsed leniently."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    k = F.col("o_orderkey") % 5
    raw = (F.when(k == 0, day).when(k == 1, F.concat(day, F.lit(" 10:11:12"))).when(k == 2, F.concat(F.lit("on "), day))
           .when(k == 3, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-02-31"))))
    orders = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return orders.select("o_orderkey", parse_date("raw").alias("date"))


def measure_sums(spark: SparkSession, sf: str) -> DataFrame:
    """One measure summed per nullable key; a group of nulls alone sums to 0."""
    orders = table(spark, sf, "orders").select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"), "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast(EXACT)).alias("value"))
    return sum_measure(orders, ["priority", "o_orderstatus"], "value").withColumn("value", F.col("value").cast("double"))


def composed_products(spark: SparkSession, sf: str) -> DataFrame:
    """Line items looked up in one dictionary composed of two."""
    codes = dims.small_table(spark, list(CHAIN_PRODUCTS), "product string, hs_code string")
    categories = dims.small_table(spark, [(code, cat) for _, code, cat in dims.TYRE_PRODUCTS if code != "401180"],
                                  "hs_code string, category string")
    both = compose_dims(codes, categories, "hs_code").select("product", "hs_code", "category")
    return lookup(_line_products(spark, sf), both, "product", known_rows=len(CHAIN_PRODUCTS)).select(
        "l_orderkey", "l_linenumber", "hs_code", "category")


def config_files(spark: SparkSession, sf: str) -> DataFrame:
    """The request plan of a config that was written as a file and read back."""
    path = _folder(spark, "config")
    star_config(spark, sf).write.json(path)
    return request_plan(read_request_config(spark, path)).select(*_OUT)


def refined_once(spark: SparkSession, sf: str) -> DataFrame:
    """Slices of a plan after one round, counted by granularity and year."""
    plan = refine_plan(request_plan(star_config(spark, sf)), slice_outcomes(spark, sf))
    return plan.groupBy("granularity", "year").agg(F.count("*").alias("n"), F.count_distinct("cache_path").alias("paths"))


def period_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of every third year without a dimension of time, of every next
    one without labelled periods: what the period probe says of each."""
    year = F.regexp_extract("source_path", r"(\d+)\.json$", 1).cast("int") % 3
    renamed = F.regexp_replace("json", r'"time":\{"category"', '"when":{"category"')
    bare = F.regexp_replace("json", r'("time":\{"category":\{"index":\{[^}]*\}\s*,\s*"label":\{)[^}]*\}', "$1}")
    texts = star_texts(spark, sf).select("source_path", F.when(year == 0, renamed).when(year == 1, bare).otherwise(
        F.col("json")).alias("json"))
    return latest_period(parse_cubes(texts)).select("source_path", "latest_period", "error")


SQL = {
    "manifest_stages": """
WITH s AS (
  SELECT 'landing/supplier_' || CAST(s_suppkey AS VARCHAR) || '.xlsx' AS source_path, s_acctbal >= 0 AS listed,
         s_nationkey <> 1 AS known, s_nationkey = 2 AS was_off, s_acctbal > 5000 AS changed,
         (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey) AS n
  FROM supplier),
m AS (
  SELECT 'lines' AS module, source_path, listed AS active,
         CASE WHEN listed AND (NOT known OR was_off OR changed) THEN n ELSE -1 END AS row_count
  FROM s WHERE listed OR known
  UNION ALL SELECT 'cells', source_path, NOT was_off, -1 FROM s WHERE known)
SELECT *, '' AS note, row_number() OVER (ORDER BY module, source_path) AS place FROM m""",
    "lenient_dates": """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1) THEN CAST(o_orderdate AS DATE) END AS date FROM orders""",
    "measure_sums": """
SELECT nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus,
       CAST(coalesce(sum(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS value
FROM orders GROUP BY ALL""",
    "composed_products": """
WITH d(product, hs_code, category) AS (VALUES ('ECONOMY', '401110', 'PCR'), ('PROMO', '401120', 'LT&TBR'),
  ('STANDARD', '40112090', 'TBR'), ('SMALL', '401170', 'ARG & FOR'), ('MEDIUM', '401180', NULL), ('LARGE', '4011', 'All'))
SELECT l_orderkey, l_linenumber, hs_code, category
FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN d ON p_type = product""",
    "config_files": PLAN_SQL["request_slices"],
    "refined_once": f"""
WITH plan AS ({PLAN_SQL['refined_slices']}),
y AS (SELECT year, count(*) AS n FROM plan WHERE granularity = 'year' GROUP BY year),
mo AS (SELECT DISTINCT indicator_alias, product_group, product_code, year, month FROM plan WHERE granularity <> 'year')
SELECT 'year' AS granularity, year, n, (SELECT count(DISTINCT cache_path) FROM plan p WHERE granularity = 'year' AND p.year = y.year) AS paths FROM y
UNION ALL
SELECT 'month', year, count(*), count(DISTINCT (indicator_alias, product_code, month)) FROM mo GROUP BY year""",
    "period_errors": """
SELECT 'landing/star/' || CAST(y AS VARCHAR) || '.json' AS source_path, CASE WHEN y % 3 = 2 THEN latest END AS latest_period,
       CASE y % 3 WHEN 0 THEN 'it has no dimension of time' WHEN 1 THEN 'its time has no labelled period' END AS error
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS y, max(strftime(l_shipdate, '%Y-%m')) AS latest FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1)""",
}

QUERIES = {"manifest_stages": manifest_stages, "lenient_dates": lenient_dates, "measure_sums": measure_sums,
           "composed_products": composed_products, "config_files": config_files, "refined_once": refined_once,
           "period_errors": period_errors}
