"""Column-expression workloads: labels, numbers, months, whole-row normalisation.

Source text with the decorations real files carry is derived from the test
tables by a CASE on a key (the same CASE in Spark and in the oracle), so every
row of the table is processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import clean_label, parse_month, safe_stem, to_measure
from ..operators import normalize_trade
from .star import star_facts
from .fixtures import materialized
from .tables import table

# Decorated customer names: the three suffix forms, blanks, and a form that
# must survive (trailing blanks after ")" stop the arrow rule).
_DECORATED_NAME = """CASE c_custkey % 5
  WHEN 0 THEN c_name || ' (incl. ' || c_mktsegment || ' ''XX'' -> 1998)'
  WHEN 1 THEN c_name || ' from 1993)'
  WHEN 2 THEN c_name || ' -> 1998'
  WHEN 3 THEN '  ' || c_name || ' -> 2001)  '
  ELSE c_name || ' ' END"""

# Account balances as text with missing markers and forms pandas rejects.
_BALANCE_TEXT = """CASE c_custkey % 8
  WHEN 0 THEN ':'
  WHEN 1 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) || ' p'
  WHEN 2 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) || 'd'
  WHEN 3 THEN '  ' || CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) || ' '
  WHEN 4 THEN 'nan'
  WHEN 5 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) || 'e1'
  WHEN 6 THEN '1,' || CAST(c_custkey AS STRING)
  ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) END"""


def clean_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Decorated reporter labels -> clean labels."""
    cust = table(spark, sf, "customer").select("c_custkey", F.expr(_DECORATED_NAME).alias("raw"))
    return cust.select("c_custkey", "raw", clean_label("raw").alias("label"))


def coerce_measures(spark: SparkSession, sf: str) -> DataFrame:
    """Text cells -> double, missing marker and bad forms -> null."""
    cust = table(spark, sf, "customer").select("c_custkey", F.expr(_BALANCE_TEXT).alias("raw"))
    return cust.select("c_custkey", "raw", to_measure("raw").alias("measure"))


def _month_text(ts: str, key: str) -> F.Column:
    d = F.col(ts)
    k = F.col(key) % 6
    return (F.when(k == 0, F.date_format(d, "yyyy-MM"))
             .when(k == 1, F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string")))
             .when(k == 2, F.date_format(d, "yyyy-MM-dd"))
             .when(k == 3, F.concat(F.lit(" "), F.date_format(d, "yyyy-MM")))
             .when(k == 4, F.concat(F.year(d).cast("string"), F.lit("-13")))
             .otherwise(F.year(d).cast("string")))


_MONTH_TEXT_SQL = """CASE {key} % 6
  WHEN 0 THEN strftime({ts}, '%Y-%m')
  WHEN 1 THEN CAST(year({ts}) AS VARCHAR) || '-' || CAST(month({ts}) AS VARCHAR)
  WHEN 2 THEN strftime({ts}, '%Y-%m-%d')
  WHEN 3 THEN ' ' || strftime({ts}, '%Y-%m')
  WHEN 4 THEN CAST(year({ts}) AS VARCHAR) || '-13'
  ELSE CAST(year({ts}) AS VARCHAR) END"""


def parse_months(spark: SparkSession, sf: str) -> DataFrame:
    """Month text (padded, unpadded and malformed) -> month date, year, month."""
    orders = table(spark, sf, "orders").select("o_orderkey", _month_text("o_orderdate", "o_orderkey").alias("raw"))
    parsed = orders.withColumn("month_date", parse_month("raw"))
    return parsed.select("o_orderkey", "raw", "month_date",
                         F.year("month_date").alias("year"), F.month("month_date").alias("month"))


def _raw_trade_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line facts as a source file would give them: decorated labels, text cells."""
    facts = star_facts(spark, sf)
    li_key = F.col("l_orderkey")
    country = (F.when(li_key % 11 == 0, F.lit("European Union - 27 countries"))
                .when(li_key % 3 == 0, F.concat("country", F.lit(" (incl. 'X' -> 1998)")))
                .otherwise(F.col("country")))
    partner = (F.when(li_key % 13 == 0, F.lit("Extra-EU27 (from 2020)"))
                .when(li_key % 4 == 1, F.concat("partner", F.lit(" from 1993)")))
                .otherwise(F.col("partner")))
    value = F.when(F.col("l_returnflag") == F.lit("N"), F.lit(":")).otherwise(
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
    return facts.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        country.alias("country"),
        _month_text("l_shipdate", "l_orderkey").alias("date"),
        F.col("product"), F.lit("VALUE_IN_EUROS").alias("indicator"),
        partner.alias("partner"),
        to_measure(value).alias("value"),
    )


def normalize_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-row normalisation: labels, months, missing cells, excluded labels."""
    raw = materialized(spark, sf, "raw_trade_rows", lambda: _raw_trade_rows(spark, sf))
    return normalize_trade(raw, "value", dims.INVALID_REPORTERS, dims.EXCLUDED_PARTNERS,
                           keep=["l_orderkey", "l_partkey", "l_suppkey"])


def safe_stems(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier names as file names -> safe stems."""
    sup = table(spark, sf, "supplier").select(
        "s_suppkey",
        F.expr("""CASE s_suppkey % 4 WHEN 0 THEN s_name || ' (copy).xlsx'
                  WHEN 1 THEN '__' || s_name || '__' WHEN 2 THEN '###' ELSE s_name END""").alias("raw"))
    return sup.select("s_suppkey", "raw", safe_stem("raw").alias("stem"))


_CLEAN_SQL = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '\\s*\\(.*', '', 'g'), "
              "'\\s*from\\s+\\d{{4}}.*?\\)$', ''), '\\s*->\\s*\\d{{4}}\\)?$', ''), '^\\s+|\\s+$', '', 'g')")
_MEASURE_SQL = ("CASE WHEN regexp_matches({x}, '(?i)^\\s*[+-]?((\\d+\\.?\\d*|\\.\\d+)(e[+-]?\\d+)?|inf(inity)?)\\s*$') "
                "THEN TRY_CAST(trim({x}) AS DOUBLE) END")


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


SQL = {
    "clean_labels": f"""
SELECT c_custkey, raw, {_CLEAN_SQL.format(x='raw')} AS label
FROM (SELECT c_custkey, {_DECORATED_NAME} AS raw FROM customer)""",
    "coerce_measures": f"""
SELECT c_custkey, raw, {_MEASURE_SQL.format(x='raw')} AS measure
FROM (SELECT c_custkey, {_BALANCE_TEXT} AS raw FROM customer)""",
    "parse_months": f"""
SELECT o_orderkey, raw, month_date, CAST(year(month_date) AS INTEGER) AS year,
       CAST(month(month_date) AS INTEGER) AS month
FROM (SELECT o_orderkey, raw,
             CASE WHEN regexp_full_match(raw, '\\d{{4}}-\\d{{1,2}}') THEN CAST(try_strptime(raw, '%Y-%m') AS DATE) END
             AS month_date
      FROM (SELECT o_orderkey, {_MONTH_TEXT_SQL.format(key='o_orderkey', ts='o_orderdate')} AS raw FROM orders))""",
    "normalize_rows": f"""
WITH f AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, rn.n_name AS country0, pn.n_name AS partner0,
         p.p_type AS product, l.l_shipdate, l.l_returnflag, l.l_extendedprice
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation rn ON c.c_nationkey = rn.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation pn ON s.s_nationkey = pn.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey),
raw AS (
  SELECT l_orderkey, l_partkey, l_suppkey, product, 'VALUE_IN_EUROS' AS indicator,
         CASE WHEN l_orderkey % 11 = 0 THEN 'European Union - 27 countries'
              WHEN l_orderkey % 3 = 0 THEN country0 || ' (incl. ''X'' -> 1998)' ELSE country0 END AS country,
         CASE WHEN l_orderkey % 13 = 0 THEN 'Extra-EU27 (from 2020)'
              WHEN l_orderkey % 4 = 1 THEN partner0 || ' from 1993)' ELSE partner0 END AS partner,
         {_MONTH_TEXT_SQL.format(key='l_orderkey', ts='l_shipdate')} AS date,
         CASE WHEN l_returnflag = 'N' THEN ':'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS value_text
  FROM f),
n AS (
  SELECT {_CLEAN_SQL.format(x='country')} AS country,
         CASE WHEN regexp_full_match(date, '\\d{{4}}-\\d{{1,2}}') THEN CAST(try_strptime(date, '%Y-%m') AS DATE) END
         AS date, product, indicator,
         {_CLEAN_SQL.format(x='partner')} AS partner,
         {_MEASURE_SQL.format(x='value_text')} AS value,
         l_orderkey, l_partkey, l_suppkey
  FROM raw)
SELECT country, date, product, indicator, partner, value, l_orderkey, l_partkey, l_suppkey,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
FROM n
WHERE country IS NOT NULL AND partner IS NOT NULL AND date IS NOT NULL AND value IS NOT NULL
  AND country NOT IN ({_in_list(dims.INVALID_REPORTERS)})
  AND partner NOT IN ({_in_list(dims.EXCLUDED_PARTNERS)})""",
    "safe_stems": """
SELECT s_suppkey, raw,
       coalesce(nullif(regexp_replace(regexp_replace(raw, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''),
                'source') AS stem
FROM (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN s_name || ' (copy).xlsx'
             WHEN 1 THEN '__' || s_name || '__' WHEN 2 THEN '###' ELSE s_name END AS raw FROM supplier)""",
}

QUERIES = {
    "clean_labels": clean_labels,
    "coerce_measures": coerce_measures,
    "parse_months": parse_months,
    "normalize_rows": normalize_rows,
    "safe_stems": safe_stems,
}
