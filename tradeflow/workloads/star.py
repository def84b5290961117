"""Trade facts over the star schema and the fact-table operator workloads.

Mapping of the star schema to trade facts: reporter = customer nation,
partner = supplier nation, product = part type, period = ship month,
value = extended price, weight (in 100 kg) = quantity. Value facts are lines
not flagged ``N``, weight facts are lines with status ``F``, so the two
measures are reported for overlapping but different key sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import month_start, scale
from ..operators import (align_measures, align_pair, bounded_broadcast, combined_product_dim, date_floor,
                         enrich_partner, keep_latest, keep_values, lookup, lookup_default, ordered,
                         strict_inline, unmapped_values)
from ..operators._broadcast import MAX_BROADCAST_ROWS
from ..operators.lookup import UnmappedValues, materialize_mapped
from ..operators.ranking import with_global_rank
from .tables import table

EXACT = "decimal(18,2)"
FLOOR = "1997-01-01"

# Star-schema part type -> product branch and HS code.
STAR_TYRE_PRODUCTS = (
    ("ECONOMY", "401110"),
    ("PROMO", "401120"),
    ("STANDARD", "40112090"),
)
STAR_VEHICLE_PRODUCTS = (
    ("SMALL", "8703"),
    ("MEDIUM", "8704"),
    ("LARGE", "8709"),
)
# Fixed value: the region left out of the partner-region table (its partners
# fall back to "Unknown").
UNMAPPED_REGION = "MIDDLE EAST"

MERGE_KEYS = ["type", "country", "date", "product", "partner", "hs_code", "category", "general_category"]
PUBLISHED = ["date", "hs_code", "product", "category", "general_category", "country", "partner",
             "value", "weight", "type", "partner_continent", "partner_sub_region", "year"]
PUBLISH_ORDER = ["type", "country", "date", "hs_code", "partner"]


def star_facts(spark: SparkSession, sf: str, floor: str | None = None,
               conform=None) -> DataFrame:
    """Line-level facts with reporter, partner, product and month labels.

    Orders are resolved to reporters first (orders-sized join), so the line
    table is shuffled once per remaining key. Parts join first and
    ``conform`` (product lookups and filters) runs right after, so lines that
    are dropped never reach the supplier and order joins. Small dimensions are
    broadcast by Spark's size statistics or AQE; the others join by shuffle.
    """
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    if floor:
        # Same rows as the floor on the month; written on the stored column so
        # the parquet scan can skip row groups.
        li = li.where(F.col("l_shipdate") >= F.lit(floor).cast("date"))
    nation = bounded_broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    reporters = (table(spark, sf, "orders").select("o_orderkey", "o_custkey")
                 .join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"),
                       "o_custkey")
                 .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")),
                       "c_nationkey")
                 .select(F.col("o_orderkey").alias("l_orderkey"), "country",
                         F.col("c_nationkey").alias("reporter_key")))
    partners = (table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
                .join(nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("partner")),
                      "s_nationkey")
                .select("l_suppkey", "partner", F.col("s_nationkey").alias("partner_key")))
    # Without table statistics Spark over-estimates this join's output and
    # plans a shuffle of the line table; a measured bound (a count that stops
    # at the limit) lets a small supplier side be broadcast instead.
    partners = bounded_broadcast(
        partners, known_rows=table(spark, sf, "supplier").limit(MAX_BROADCAST_ROWS + 1).count())
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"))
    lines = li.join(parts, "l_partkey")
    if conform is not None:
        lines = conform(lines)
    return (lines.join(partners, "l_suppkey").join(reporters, "l_orderkey")
                 .withColumn("date", month_start("l_shipdate")))


def star_product_dim(spark: SparkSession) -> DataFrame:
    """Part type -> type, hs_code, category, general_category, keep."""
    tyre_codes = dict((code, cat) for _label, code, cat in dims.TYRE_PRODUCTS)
    tyre = dims.small_table(spark, [(p, c, tyre_codes.get(c)) for p, c in STAR_TYRE_PRODUCTS],
                                 "product string, hs_code string, category string")
    vehicle = dims.small_table(spark, list(STAR_VEHICLE_PRODUCTS), "product string, hs_code string")
    return combined_product_dim(tyre, dims.tyre_category_dim(spark), vehicle, dims.vehicle_general_dim(spark),
                                dims.VEHICLE_EXCLUDED_HS)


def star_partner_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Partner -> continent (region name) and sub-region, one region left out."""
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region").where(F.col("r_name") != F.lit(UNMAPPED_REGION))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("partner"),
        F.col("r_name").alias("partner_continent"),
        F.lower("r_name").alias("partner_sub_region"),
    )


def merged_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Published table: aligned value and weight per key, both branches, enriched."""
    n_products = len(STAR_TYRE_PRODUCTS) + len(STAR_VEHICLE_PRODUCTS)

    def conform(lines: DataFrame) -> DataFrame:
        out = lookup(lines, star_product_dim(spark), "product",
                     ["type", "hs_code", "category", "general_category", "keep"], known_rows=n_products)
        out = strict_inline(out, "product", "hs_code", "star facts").where(F.col("keep"))
        # The published categories filter is on a grouping key, so it may run
        # before the alignment; here it also shrinks the later joins.
        return keep_values(out, "general_category", dims.FINAL_GENERAL_CATEGORIES)

    facts = star_facts(spark, sf, FLOOR, conform)
    has_value = F.coalesce(F.col("l_returnflag") != F.lit("N"), F.lit(False))
    has_weight = F.coalesce(F.col("l_linestatus") == F.lit("F"), F.lit(False))
    flagged = facts.select(
        "type", "country", "date", "product", "partner", "hs_code", "category", "general_category",
        F.when(has_value, F.col("l_extendedprice").cast(EXACT)).alias("value"),
        F.when(has_weight, F.col("l_quantity").cast(EXACT)).alias("weight"),
        has_value.alias("__has_value"), has_weight.alias("__has_weight"),
    ).where(has_value | has_weight)
    aligned = align_measures(flagged, MERGE_KEYS, ["value", "weight"])
    out = aligned.withColumn("weight", scale("weight", dims.WEIGHT_FACTOR))
    out = enrich_partner(out, star_partner_dim(spark, sf))
    out = date_floor(out, "date", FLOOR)
    return out.select(
        *[F.col(c) for c in PUBLISHED if c not in ("value", "weight", "year")],
        F.col("value").cast("double").alias("value"),
        F.col("weight").cast("double").alias("weight"),
        F.year("date").alias("year"),
    ).select(*PUBLISHED)


def merge_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: the published table in published order."""
    return ordered(merged_facts(spark, sf), PUBLISH_ORDER, numeric=["hs_code"])


def published_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """Published table with its 1-based position in the published order."""
    return with_global_rank(merged_facts(spark, sf), PUBLISH_ORDER, "rank", numeric=["hs_code"])


def align_nullable_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Alignment with a nullable key, one-sided groups and all-null measures."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        "o_orderdate", "o_totalprice")
    keys = ["o_orderstatus", "priority", "month"]
    value_side = orders.select(
        "o_orderstatus", "priority", month_start("o_orderdate").alias("month"),
        F.when(F.col("o_orderstatus") != F.lit("P"), F.col("o_totalprice").cast(EXACT)).alias("value"))
    weight_side = (table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
                   .join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "priority"),
                         "l_orderkey")
                   .select("o_orderstatus", "priority", month_start("l_shipdate").alias("month"),
                           F.col("l_quantity").cast(EXACT).alias("weight")))
    aligned = align_pair(value_side, weight_side, keys)
    return aligned.select(*keys, F.col("value").cast("double").alias("value"),
                          F.col("weight").cast("double").alias("weight"))


def keep_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Line rows as overlapping snapshots: latest per (order, line number)."""
    li = table(spark, sf, "lineitem")
    return keep_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_suppkey", "l_partkey"])


def _line_products(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"))
    return li.join(part, "l_partkey").drop("l_partkey")


# Part type -> tyre HS code for the chained-lookup workload.
CHAIN_PRODUCTS = (
    ("ECONOMY", "401110"),
    ("PROMO", "401120"),
    ("STANDARD", "40112090"),
    ("SMALL", "401170"),
    ("MEDIUM", "401180"),
    ("LARGE", "4011"),
)


def product_lookup_strict(spark: SparkSession, sf: str) -> DataFrame:
    """product -> HS code -> category -> general category, every step strict."""
    code_dim = dims.small_table(spark, list(CHAIN_PRODUCTS), "product string, hs_code string")
    cat_dim = dims.small_table(spark, [(code, cat) for _l, code, cat in dims.TYRE_PRODUCTS],
                                    "hs_code string, category string")
    gen_dim = dims.tyre_category_dim(spark)
    out = lookup(_line_products(spark, sf), code_dim, "product", ["hs_code"], known_rows=len(CHAIN_PRODUCTS))
    out = lookup(out, cat_dim, "hs_code", ["category"], known_rows=len(dims.TYRE_PRODUCTS))
    out = lookup(out, gen_dim, "category", ["general_category"], known_rows=len(dims.TYRE_CATEGORY_GENERAL))
    out = materialize_mapped(out, [("product", "hs_code"), ("hs_code", "category"),
                                   ("category", "general_category")], "star lines")
    return out.select("l_orderkey", "l_linenumber", "product", "hs_code", "category", "general_category")


def partner_lookup_default(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier partners enriched with region attributes, default Unknown."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"),
                                               F.col("n_name").alias("partner"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey").join(
        bounded_broadcast(nation), "s_nationkey")
    out = enrich_partner(suppliers, star_partner_dim(spark, sf))
    return out.select("s_suppkey", "partner", "partner_continent", "partner_sub_region")


# The part types the audit dictionary knows (two are left out).
AUDIT_KNOWN = ("ECONOMY", "PROMO", "STANDARD", "SMALL")


def unmapped_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted distinct product labels the dictionary does not map."""
    code_dim = dims.small_table(spark, [(p, c) for p, c in CHAIN_PRODUCTS if p in AUDIT_KNOWN],
                                     "product string, hs_code string")
    out = lookup(_line_products(spark, sf), code_dim, "product", ["hs_code"], known_rows=len(AUDIT_KNOWN))
    return unmapped_values(out, "product", "hs_code")


# Codes whose category the failing strict lookup knows.
STRICT_KNOWN = ("401110", "401120", "40112090")


def unmapped_strict(spark: SparkSession, sf: str) -> DataFrame:
    """What a strict two-step lookup over whole line items reports when types
    and codes are missing from its dictionaries."""
    code_dim = dims.small_table(spark, [(p, c) for p, c in CHAIN_PRODUCTS if p != "LARGE"],
                                "product string, hs_code string")
    cat_dim = dims.small_table(spark, [(code, cat) for _l, code, cat in dims.TYRE_PRODUCTS if code in STRICT_KNOWN],
                               "hs_code string, category string")
    out = lookup(_line_products(spark, sf), code_dim, "product", ["hs_code"], known_rows=len(CHAIN_PRODUCTS))
    out = lookup(out, cat_dim, "hs_code", ["category"], known_rows=len(STRICT_KNOWN))
    try:
        materialize_mapped(out, [("product", "hs_code"), ("hs_code", "category")], "star lines")
    except UnmappedValues as failed:
        return spark.read.schema("source string, target string, value string").parquet(failed.table)
    return spark.createDataFrame([], "source string, target string, value string")


def partner_region_default(spark: SparkSession, sf: str) -> DataFrame:
    """Aligned totals per partner continent; unknown partners grouped under the default."""
    facts = star_facts(spark, sf).select("partner", F.col("l_extendedprice").cast(EXACT).alias("value"))
    out = lookup_default(facts, star_partner_dim(spark, sf), "partner",
                         {"partner_continent": "Unknown"})
    return (out.groupBy("partner_continent")
               .agg(F.sum("value").cast("double").alias("value"), F.count(F.lit(1)).alias("lines")))


def _star_sql() -> str:
    return """
      SELECT rn.n_name AS country, pn.n_name AS partner, p.p_type AS product,
             CAST(date_trunc('month', l.l_shipdate) AS DATE) AS date,
             l.l_returnflag, l.l_linestatus,
             CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price,
             CAST(l.l_quantity AS DECIMAL(18,2)) AS qty
      FROM lineitem l
      JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation rn ON c.c_nationkey = rn.n_nationkey
      JOIN supplier s ON l.l_suppkey = s.s_suppkey
      JOIN nation pn ON s.s_nationkey = pn.n_nationkey
      JOIN part p ON l.l_partkey = p.p_partkey"""


_PARTNER_DIM_SQL = """
      SELECT n.n_name AS partner, r.r_name AS partner_continent, lower(r.r_name) AS partner_sub_region
      FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
      WHERE r.r_name <> 'MIDDLE EAST'"""

_MERGED_SQL = f"""
WITH f AS ({_star_sql()}),
pd(product, type, hs_code, category, general_category) AS (VALUES
  ('ECONOMY', 'Tyre', '401110', 'PCR', 'PCR'),
  ('PROMO', 'Tyre', '401120', 'LT&TBR', 'LT&TBR'),
  ('STANDARD', 'Tyre', '40112090', 'TBR', 'TBR'),
  ('SMALL', 'Vehicle', '8703', NULL, 'PCR'),
  ('MEDIUM', 'Vehicle', '8704', NULL, 'TBR')),
fc AS (SELECT f.*, pd.type, pd.hs_code, pd.category, pd.general_category FROM f JOIN pd USING (product)),
v AS (SELECT type, country, date, product, partner, hs_code, category, general_category, SUM(price) AS value
      FROM fc WHERE l_returnflag <> 'N' GROUP BY ALL),
w AS (SELECT type, country, date, product, partner, hs_code, category, general_category, SUM(qty) AS weight
      FROM fc WHERE l_linestatus = 'F' GROUP BY ALL),
m AS (SELECT v.*, w.weight * 100 AS weight FROM v JOIN w
      ON v.type IS NOT DISTINCT FROM w.type AND v.country IS NOT DISTINCT FROM w.country
     AND v.date IS NOT DISTINCT FROM w.date AND v.product IS NOT DISTINCT FROM w.product
     AND v.partner IS NOT DISTINCT FROM w.partner AND v.hs_code IS NOT DISTINCT FROM w.hs_code
     AND v.category IS NOT DISTINCT FROM w.category
     AND v.general_category IS NOT DISTINCT FROM w.general_category),
pr AS ({_PARTNER_DIM_SQL})
SELECT m.date, m.hs_code, m.product, m.category, m.general_category, m.country, m.partner,
       CAST(m.value AS DOUBLE) AS value, CAST(m.weight AS DOUBLE) AS weight, m.type,
       coalesce(pr.partner_continent, 'Unknown') AS partner_continent,
       coalesce(pr.partner_sub_region, 'Unknown') AS partner_sub_region,
       CAST(year(m.date) AS INTEGER) AS year
FROM m LEFT JOIN pr USING (partner)
WHERE m.general_category IN ('PCR', 'TBR', 'Specialty') AND m.date >= DATE '1997-01-01'"""

SQL = {
    "merge_facts": _MERGED_SQL + "\nORDER BY type, country, date, CAST(hs_code AS BIGINT), partner",
    "published_sorted": f"""
SELECT *, row_number() OVER (ORDER BY type NULLS LAST, country NULLS LAST, date NULLS LAST,
                             CAST(hs_code AS BIGINT) NULLS LAST, hs_code NULLS LAST, partner NULLS LAST) AS rank
FROM ({_MERGED_SQL}) t""",
    "align_nullable_keys": """
WITH o AS (SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority, o_orderdate,
                  o_totalprice FROM orders),
v AS (SELECT o_orderstatus, priority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             coalesce(SUM(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS value
      FROM o GROUP BY ALL),
w AS (SELECT o.o_orderstatus, o.priority, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month,
             coalesce(SUM(CAST(l.l_quantity AS DECIMAL(18,2))), 0) AS weight
      FROM lineitem l JOIN o ON l.l_orderkey = o.o_orderkey GROUP BY ALL)
SELECT v.o_orderstatus, v.priority, v.month, CAST(v.value AS DOUBLE) AS value, CAST(w.weight AS DOUBLE) AS weight
FROM v JOIN w ON v.o_orderstatus IS NOT DISTINCT FROM w.o_orderstatus
 AND v.priority IS NOT DISTINCT FROM w.priority AND v.month IS NOT DISTINCT FROM w.month""",
    "keep_latest_snapshot": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS FIRST, l_suppkey DESC NULLS FIRST, l_partkey DESC NULLS FIRST) = 1""",
    "product_lookup_strict": """
WITH code(product, hs_code) AS (VALUES ('ECONOMY', '401110'), ('PROMO', '401120'), ('STANDARD', '40112090'),
                                       ('SMALL', '401170'), ('MEDIUM', '401180'), ('LARGE', '4011')),
cat(hs_code, category) AS (VALUES ('4011', 'All'), ('401110', 'PCR'), ('401120', 'LT&TBR'), ('40112010', 'LT'),
                                  ('40112090', 'TBR'), ('401170', 'ARG & FOR'), ('401180', 'GC & Mining & MH')),
gen(category, general_category) AS (VALUES ('PCR', 'PCR'), ('LT', 'PCR'), ('TBR', 'TBR'), ('LT&TBR', 'LT&TBR'),
                                   ('ARG & FOR', 'Specialty'), ('GC & Mining & MH', 'Specialty'), ('All', 'All'))
SELECT l.l_orderkey, l.l_linenumber, p.p_type AS product, code.hs_code, cat.category, gen.general_category
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN code ON p.p_type = code.product JOIN cat ON code.hs_code = cat.hs_code
JOIN gen ON cat.category = gen.category""",
    "partner_lookup_default": f"""
SELECT s.s_suppkey, n.n_name AS partner, coalesce(pr.partner_continent, 'Unknown') AS partner_continent,
       coalesce(pr.partner_sub_region, 'Unknown') AS partner_sub_region
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN ({_PARTNER_DIM_SQL}) pr ON n.n_name = pr.partner""",
    "unmapped_audit": """
SELECT DISTINCT p.p_type AS product FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE p.p_type NOT IN ('ECONOMY', 'PROMO', 'STANDARD', 'SMALL') ORDER BY 1""",
    "unmapped_strict": """
WITH codes(product, hs_code) AS (VALUES ('ECONOMY', '401110'), ('PROMO', '401120'), ('STANDARD', '40112090'),
  ('SMALL', '401170'), ('MEDIUM', '401180'))
SELECT DISTINCT CASE WHEN hs_code IS NULL THEN 'product' ELSE 'hs_code' END AS source,
       CASE WHEN hs_code IS NULL THEN 'hs_code' ELSE 'category' END AS target, coalesce(hs_code, p_type) AS value
FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN codes ON p_type = product
WHERE p_type IS NOT NULL AND coalesce(hs_code, '') NOT IN ('401110', '401120', '40112090')""",
    "partner_region_default": f"""
WITH f AS ({_star_sql()})
SELECT coalesce(pr.partner_continent, 'Unknown') AS partner_continent,
       CAST(SUM(f.price) AS DOUBLE) AS value, COUNT(*) AS lines
FROM f LEFT JOIN ({_PARTNER_DIM_SQL}) pr ON f.partner = pr.partner GROUP BY 1""",
}

QUERIES = {
    "merge_facts": merge_facts,
    "published_sorted": published_sorted,
    "align_nullable_keys": align_nullable_keys,
    "keep_latest_snapshot": keep_latest_snapshot,
    "product_lookup_strict": product_lookup_strict,
    "partner_lookup_default": partner_lookup_default,
    "unmapped_audit": unmapped_audit,
    "unmapped_strict": unmapped_strict,
    "partner_region_default": partner_region_default,
}
