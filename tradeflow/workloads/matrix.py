"""Matrix workloads: spreadsheet cells laid out by Spark from the orders table.

One workbook per order year, one tab per order status (status P goes to a tab
named "Notes P", which the reader must skip), rows = (customer nation, order
month), one column per order priority. Header texts repeat on purpose (two
priorities share the label LOW). Cells of a single order are written as the
missing marker ":".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..operators import bounded_broadcast
from ..operators.matrix import HEADER_ROW, dedupe_headers, matrix_to_long, unpivot_measures
from .fixtures import materialized
from .tables import table

# Priority -> (column, header text) in the synthetic tabs.
PRIORITY_COLUMNS = (
    ("1-URGENT", 2, "URGENT"),
    ("2-HIGH", 3, "HIGH"),
    ("3-MEDIUM", 4, "MEDIUM"),
    ("4-NOT SPECIFIED", 5, "LOW"),
    ("5-LOW", 6, "LOW"),
)
DATA_ROW = HEADER_ROW + 2
MONTHS_PER_NATION = 12


def _sheet_name() -> F.Column:
    return F.when(F.col("o_orderstatus") == F.lit("P"), F.lit("Notes P")).otherwise(
        F.concat(F.lit("Sheet "), F.col("o_orderstatus")))


def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The cells table of the synthetic workbooks."""
    orders = table(spark, sf, "orders")
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = bounded_broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    pcols = dims.small_table(spark, list(PRIORITY_COLUMNS), "o_orderpriority string, col int, header string")
    base = (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(bounded_broadcast(pcols, len(PRIORITY_COLUMNS)), "o_orderpriority")
            .select(F.year("o_orderdate").alias("year"), "o_orderstatus", "n_nationkey", "n_name",
                    F.month("o_orderdate").alias("month"), "col", "o_totalprice"))
    agg = base.groupBy("year", "o_orderstatus", "n_nationkey", "n_name", "month", "col").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"), F.count(F.lit(1)).alias("n"))
    sheet_cols = {
        "source_name": F.concat(F.lit("orders_"), F.col("year").cast("string"), F.lit(".xlsx")),
        "source_path": F.concat(F.lit("landing/orders_"), F.col("year").cast("string"), F.lit(".xlsx")),
        "source_mtime": F.make_timestamp(F.col("year") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)),
        "sheet_ord": F.when(F.col("o_orderstatus") == F.lit("F"), F.lit(0))
                      .when(F.col("o_orderstatus") == F.lit("O"), F.lit(1)).otherwise(F.lit(2)),
        "sheet": _sheet_name(),
    }
    row = F.lit(DATA_ROW) + F.col("n_nationkey") * MONTHS_PER_NATION + F.col("month") - 1
    value_cells = agg.select(
        "year", "o_orderstatus", row.alias("row"), "col",
        F.when(F.col("n") > 1, F.col("total").cast("string")).otherwise(F.lit(":")).alias("text"))
    label = F.when(F.col("n_nationkey") % 4 == 0, F.concat("n_name", F.lit(" (incl. X -> 1998)"))).otherwise(
        F.col("n_name"))
    key_cells = agg.select("year", "o_orderstatus", "n_nationkey", "n_name", "month").distinct().select(
        "year", "o_orderstatus", row.alias("row"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("col"), label.alias("text")),
            F.struct(F.lit(1).alias("col"), F.format_string("%04d-%02d", "year", "month").alias("text")),
        )).alias("c")).select("year", "o_orderstatus", "row", "c.col", "c.text")
    fixed = [(4, 0, "Monthly"), (5, 2, None), (6, 2, "IMPORT"), (7, 0, "VALUE_IN_EUROS"),
             (HEADER_ROW, 0, "REPORTER/PERIOD"), (HEADER_ROW + 1, 0, "units")]
    fixed += [(HEADER_ROW, c, h) for _p, c, h in PRIORITY_COLUMNS]
    fixed += [(HEADER_ROW + 1, c, "EUR") for _p, c, _h in PRIORITY_COLUMNS]
    # The fixed layout cells of each tab, generated per tab row (no join).
    layout = F.explode(F.array(*[
        F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), F.lit(t).cast("string").alias("text"))
        for r, c, t in fixed]))
    sheets = agg.select("year", "o_orderstatus").distinct()
    frame_cells = sheets.select("year", "o_orderstatus", layout.alias("l")).select(
        "year", "o_orderstatus", "l.row", "l.col",
        F.coalesce(F.col("l.text"), F.concat(F.lit("Orders "), F.col("o_orderstatus"))).alias("text"))
    cells = value_cells.unionByName(key_cells).unionByName(frame_cells)
    return cells.select(*[e.alias(n) for n, e in sheet_cols.items()], "row", "col", "text")


def matrix_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Matrix tabs -> long rows with metadata, cleaned of the units row."""
    long = matrix_to_long(materialized(spark, sf, "order_cells", lambda: order_cells(spark, sf)))
    return long.select("source_name", "sheet", "row", "country", "date", "frequency", "product", "flow",
                       "indicator", "partner", "partner_ord", "value")


def incomplete_tabs(spark: SparkSession, sf: str) -> DataFrame:
    """The same tabs, some damaged: those of years divisible by three keep only
    the header block, of the others tabs of status O lose the cells of column 0
    (so the month and the first priority move up) and the header of column 3."""
    cells = materialized(spark, sf, "order_cells", lambda: order_cells(spark, sf))
    year = F.regexp_extract("source_name", r"(\d{4})", 1).cast("int")
    data, status_o = F.col("row") >= DATA_ROW, F.col("sheet") == "Sheet O"
    gone = ((year % 3 == 0) & data) | (status_o & data & (F.col("col") == 0)) | (
        status_o & (F.col("row") == HEADER_ROW) & (F.col("col") == 3))
    long = matrix_to_long(cells.where(~gone))
    return long.select("source_name", "sheet", "row", "country", "date", "product", "partner", "value")


def dup_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Brand headers per part-size tab; repeated brands get .1, .2 ..."""
    part = table(spark, sf, "part")
    headers = part.select(F.concat(F.lit("Sheet "), F.col("p_size").cast("string")).alias("sheet"),
                          F.col("p_partkey").alias("col"), F.col("p_brand").alias("text"))
    return dedupe_headers(headers, ["sheet"]).select("sheet", "col", "header")


def unpivot_priorities(spark: SparkSession, sf: str) -> DataFrame:
    """Orders pivoted to one text column per priority, then unpivoted and coerced."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"), "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    priorities = [p for p, _c, _h in PRIORITY_COLUMNS]
    wide = orders.groupBy("o_custkey", "month").pivot("o_orderpriority", priorities).agg(
        F.sum("price").cast("string"))
    wide = wide.select("o_custkey", "month", *[F.coalesce(F.col(f"`{p}`"), F.lit(":")).alias(p) for p in priorities])
    long = unpivot_measures(wide, ["o_custkey", "month"], "partner", "value")
    return long.where(F.col("value").isNotNull())


_LAYOUT = """(VALUES ('1-URGENT', 2, 'URGENT'), ('2-HIGH', 3, 'HIGH'), ('3-MEDIUM', 4, 'MEDIUM'),
                    ('4-NOT SPECIFIED', 5, 'LOW'), ('5-LOW', 6, 'LOW.1')) AS pc(o_orderpriority, col, partner)"""

SQL = {
    "matrix_sheets": f"""
WITH agg AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, o.o_orderstatus, n.n_nationkey, n.n_name,
         CAST(month(o.o_orderdate) AS INTEGER) AS month, pc.col, pc.partner,
         SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN {_LAYOUT} USING (o_orderpriority)
  GROUP BY ALL),
firsts AS (SELECT year, partner,
                  min((CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) * 100000 + col) AS first_key
           FROM agg WHERE o_orderstatus <> 'P' GROUP BY ALL),
ords AS (SELECT year, partner,
                CAST(dense_rank() OVER (PARTITION BY year ORDER BY first_key) - 1 AS INTEGER) AS partner_ord
         FROM firsts)
SELECT 'orders_' || CAST(year AS VARCHAR) || '.xlsx' AS source_name, 'Sheet ' || agg.o_orderstatus AS sheet,
       11 + n_nationkey * 12 + month - 1 AS row,
       CASE WHEN n_nationkey % 4 = 0 THEN n_name || ' (incl. X -> 1998)' ELSE n_name END AS country,
       CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS date,
       'Monthly' AS frequency, 'Orders ' || agg.o_orderstatus AS product, 'IMPORT' AS flow,
       'VALUE_IN_EUROS' AS indicator, agg.partner, ords.partner_ord,
       CASE WHEN n > 1 THEN CAST(total AS DOUBLE) END AS value
FROM agg JOIN ords USING (year, partner) WHERE agg.o_orderstatus <> 'P'""",
    "incomplete_tabs": """
WITH agg AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, o.o_orderstatus AS st, n.n_nationkey, n.n_name,
         CAST(month(o.o_orderdate) AS INTEGER) AS month, pc.col, pc.partner,
         SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN (VALUES ('1-URGENT', 2, 'URGENT'), ('2-HIGH', 3, 'HIGH'), ('3-MEDIUM', 4, 'MEDIUM'),
               ('4-NOT SPECIFIED', 5, 'LOW'), ('5-LOW', 6, 'LOW.1')) AS pc(o_orderpriority, col, partner)
    USING (o_orderpriority)
  WHERE year(o.o_orderdate) % 3 <> 0 AND o.o_orderstatus <> 'P'
  GROUP BY ALL),
first_col AS (SELECT year, min(col) AS c FROM agg WHERE st = 'O' GROUP BY year),
moved AS (SELECT year, n_nationkey, month,
                 max(CASE WHEN n > 1 THEN CAST(total AS VARCHAR) ELSE ':' END) AS text
          FROM agg JOIN first_col USING (year) WHERE st = 'O' AND col = c GROUP BY ALL)
SELECT 'orders_' || CAST(year AS VARCHAR) || '.xlsx' AS source_name, 'Sheet ' || st AS sheet,
       11 + n_nationkey * 12 + month - 1 AS row,
       CASE WHEN st = 'O' THEN CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0')
            WHEN n_nationkey % 4 = 0 THEN n_name || ' (incl. X -> 1998)' ELSE n_name END AS country,
       CASE WHEN st = 'O' THEN moved.text
            ELSE CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') END AS date,
       'Orders ' || st AS product,
       CASE WHEN st = 'O' AND col = 3 THEN 'Unnamed: 3' ELSE partner END AS partner,
       CASE WHEN n > 1 THEN CAST(total AS DOUBLE) END AS value
FROM agg LEFT JOIN first_col USING (year) LEFT JOIN moved USING (year, n_nationkey, month)
WHERE st <> 'O' OR col <> c""",
    "dup_headers": """
SELECT 'Sheet ' || CAST(p_size AS VARCHAR) AS sheet, p_partkey AS col,
       CASE WHEN rn = 0 THEN p_brand ELSE p_brand || '.' || CAST(rn AS VARCHAR) END AS header
FROM (SELECT p_size, p_partkey, p_brand,
             row_number() OVER (PARTITION BY p_size, p_brand ORDER BY p_partkey) - 1 AS rn FROM part)""",
    "unpivot_priorities": """
SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS partner,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM orders GROUP BY ALL""",
}

QUERIES = {
    "matrix_sheets": matrix_sheets,
    "incomplete_tabs": incomplete_tabs,
    "dup_headers": dup_headers,
    "unpivot_priorities": unpivot_priorities,
}
