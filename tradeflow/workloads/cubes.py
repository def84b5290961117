"""Cube workloads: JSON-stat responses encoded by Spark from the star facts.

One response document per ship year, a file each, laid out like the statistics API:
dimensions freq x reporter x partner x product x indicators x time, cells
stored sparsely by flat row-major index. Cell values are exact decimal sums
(value: extended price of lines not flagged N; weight: quantity of lines with
status F). The documents go through JSON text and are parsed back, so decode
sees what a landing folder would hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..operators import bounded_broadcast
from ..operators.cube import CONFORM_DIMS, check_latest_periods, conform_cube, cube_cell_counts, decode_cube
from ..operators.cube import latest_period as latest_period_op
from ..operators.cube_encode import CubeDim, encode_cubes, write_documents
from ..operators.ranking import with_global_rank
from ..sources.cubes import cube_errors, parse_cubes, require_whole_cubes, scan_cubes
from ..sources.large_cubes import decode_large, require_whole_large, scan_large_cubes
from .star import EXACT, STAR_TYRE_PRODUCTS, STAR_VEHICLE_PRODUCTS, star_facts
from .fixtures import landed
from .tables import table

# Product dimension of the star cube, in position order.
CUBE_PRODUCTS = STAR_TYRE_PRODUCTS + STAR_VEHICLE_PRODUCTS
INDICATOR_CODES = ("VALUE_IN_EUROS", "QUANTITY_IN_100KG")
# Reporter key whose label the cube leaves out (label = code),
# and the step of keys whose labels carry a validity note.
UNLABELLED_REPORTER = 24
NOTE_EVERY = 5


def star_cells(spark: SparkSession, sf: str) -> DataFrame:
    """(year, reporter_key, partner_key, product, date) -> value/weight sums and counts."""
    facts = star_facts(spark, sf)
    has_v = F.col("l_returnflag") != F.lit("N")
    has_w = F.col("l_linestatus") == F.lit("F")
    return facts.groupBy(F.year("date").alias("year"), "reporter_key", "partner_key", "product", "date").agg(
        F.sum(F.when(has_v, F.col("l_extendedprice").cast(EXACT))).alias("v"),
        F.count(F.when(has_v, F.lit(1))).alias("nv"),
        F.sum(F.when(has_w, F.col("l_quantity").cast(EXACT))).alias("w"),
        F.count(F.when(has_w, F.lit(1))).alias("nw"),
    )


def coded_cells(spark: SparkSession, sf: str) -> DataFrame:
    """A row per stored cell, both indicators stacked: year, the codes of all
    dimensions, value, status ('p' for a single line, else null)."""
    products = dims.small_table(spark, list(CUBE_PRODUCTS), "product string, product_code string")
    sides = F.explode(F.array(*[
        F.struct(F.lit(code).alias("indicator_code"), F.col(amount).cast("double").alias("value"), F.col(n).alias("n"))
        for code, amount, n in zip(INDICATOR_CODES, ("v", "w"), ("nv", "nw"))]))
    stacked = star_cells(spark, sf).select("year", "reporter_key", "partner_key", "product", "date", sides.alias("s"))
    return stacked.where(F.col("s.n") > 0).join(bounded_broadcast(products, len(CUBE_PRODUCTS)), "product").select(
        "year", F.lit("M").alias("freq_code"), _nation_code("reporter_key").alias("reporter_code"),
        _nation_code("partner_key").alias("partner_code"), "product_code", "s.indicator_code",
        F.date_format("date", "yyyy-MM").alias("time_code"), "s.value",
        F.when(F.col("s.n") < 2, F.lit("p")).alias("status"))


def _nation_code(key: str) -> F.Column:
    return F.concat(F.lit("N"), F.col(key).cast("string"))


def _cube_dims(spark: SparkSession, sf: str) -> list[CubeDim]:
    """The dimensions of the star cube; time has the months of each document."""
    nation = with_global_rank(table(spark, sf, "nation").select("n_nationkey", "n_name"), ["n_nationkey"], "__rank")
    note = F.when(F.col("n_nationkey") % NOTE_EVERY == 0, F.concat("n_name", F.lit(" (incl. X from 1991)"))).otherwise(
        F.col("n_name"))
    codes = [_nation_code("n_nationkey").alias("code"), (F.col("__rank") - 1).alias("pos")]
    reporters = nation.select(*codes, F.when(F.col("n_nationkey") != UNLABELLED_REPORTER, note).alias("label"))

    def fixed(rows: list[tuple[str, str]]) -> DataFrame:
        return dims.small_table(spark, [(c, label, k) for k, (c, label) in enumerate(rows)],
                                "code string, label string, pos int")
    return [CubeDim("freq", "freq_code", fixed([("M", "Monthly")])),
            CubeDim("reporter", "reporter_code", reporters),
            CubeDim("partner", "partner_code", nation.select(*codes, F.col("n_name").alias("label"))),
            CubeDim("product", "product_code", fixed([(code, p) for p, code in CUBE_PRODUCTS])),
            CubeDim("indicators", "indicator_code", fixed([(c, c) for c in INDICATOR_CODES])),
            CubeDim("time", "time_code")]


def _year_header() -> dict[str, F.Column]:
    year = F.col("year").cast("string")
    return {"label": F.concat(F.lit("Star trade "), year), "datasetId": F.concat(F.lit("star-"), year),
            "updated": F.concat((F.col("year") + 1).cast("string"), F.lit("-02-01T00:00:00+0000"))}


def star_texts(spark: SparkSession, sf: str) -> DataFrame:
    """JSON text of one response document per year: (source_path, json), read
    from files that are written once per session (as a landing folder holds them)."""
    folder = landed(spark, sf, "cube_docs", lambda path: write_documents(
        encode_cubes(coded_cells(spark, sf), ["year"], _cube_dims(spark, sf), _year_header()), path, "year"))
    return spark.read.text(folder, wholetext=True).select(
        F.concat(F.lit("landing/star/"), F.col("year").cast("string"), F.lit(".json")).alias("source_path"),
        F.col("value").alias("json"))


def star_cubes(spark: SparkSession, sf: str) -> DataFrame:
    """The response documents, parsed by each query."""
    return parse_cubes(star_texts(spark, sf))


CUBE_DIMS = ["reporter", "partner", "product", "indicator", "time"]


def cube_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Decode every stored cell to codes and labels."""
    long = decode_cube(star_cubes(spark, sf), dims=CUBE_DIMS)
    return long.select("dataset_code", "flat_index", "value", "status",
                       *[f"{d}_{kind}" for d in CUBE_DIMS for kind in ("code", "label")])


def cube_latest_period(spark: SparkSession, sf: str) -> DataFrame:
    """Latest time label per response document."""
    return check_latest_periods(latest_period_op(star_cubes(spark, sf))).select(
        "dataset_code", "latest_period", "updated")


def cube_slice_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Stored cells and decoded rows per response document, in one pass."""
    decoded = F.cardinality(F.map_filter("value", lambda _k, v: v.isNotNull()))
    cubes = star_cubes(spark, sf).withColumn("__decoded", F.coalesce(decoded, F.lit(0)).cast("long"))
    counts = cube_cell_counts(cubes, keep=("__decoded", F.col("extension.datasetId").alias("dataset_code")))
    return counts.select("dataset_code", "cell_count", "row_count", F.col("__decoded").alias("decoded_rows"),
                         "response_updated")


def damaged_docs(spark: SparkSession, sf: str) -> DataFrame:
    """The response documents, three of four years damaged: cut off, cells as a
    list, one cell that is no number, whole."""
    texts = star_texts(spark, sf)
    kind = F.regexp_extract("source_path", r"(\d+)\.json$", 1).cast("int") % 4
    return texts.select("source_path", (
        F.when(kind == 0, F.expr("substring(json, 1, length(json) div 2)"))
        .when(kind == 1, F.regexp_replace("json", r'"value":\{[^}]*\}', '"value":[1.0,2.0]'))
        .when(kind == 2, F.regexp_replace("json", r'"value":\{\s*("\d+"):[^,}]*', r'"value":{$1:"n/a"'))
        .otherwise(F.col("json"))).alias("json"))


def cube_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Cells encoded to one document per indicator, product and year, written,
    read back and decoded: the cells again."""
    doc = F.concat_ws("_", "indicator_code", "product_code", F.col("year").cast("string"))
    nation = table(spark, sf, "nation").select(_nation_code("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    sides = [CubeDim("reporter", "reporter_code", nation), CubeDim("partner", "partner_code", nation),
             *[CubeDim(d, f"{c}_code") for d, c in (("product", "product"), ("indicators", "indicator"), ("time", "time"))]]
    header = {"label": F.col("doc"), "updated": F.lit(""), "datasetId": F.col("doc")}
    folder = landed(spark, sf, "cube_slices", lambda path: write_documents(
        encode_cubes(coded_cells(spark, sf).withColumn("doc", doc), ["doc"], sides, header), path, "doc"))
    long = decode_cube(require_whole_cubes(scan_cubes(spark, folder, glob="*.txt")), dims=CUBE_DIMS)
    return long.select("dataset_code", "value", "status", *[f"{d}_code" for d in CUBE_DIMS], "reporter_label", "partner_label")


def cube_large_doc(spark: SparkSession, sf: str) -> DataFrame:
    """All cells as one document, read by byte ranges and decoded."""
    header = {"label": F.lit("Star trade"), "updated": F.lit("now"), "datasetId": F.col("doc")}
    folder = landed(spark, sf, "cube_whole", lambda path: write_documents(
        encode_cubes(coded_cells(spark, sf).withColumn("doc", F.lit("star")), ["doc"], _cube_dims(spark, sf), header),
        path, "doc"))
    long = decode_large(require_whole_large(scan_large_cubes(spark, folder, glob="*.txt")), CUBE_DIMS)
    return long.select("dataset_code", "dataset_label", "flat_index", "value", "status",
                       *[f"{d}_{kind}" for d in CUBE_DIMS for kind in ("code", "label")])


def cube_errors_q(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that cannot be decoded whole."""
    return cube_errors(parse_cubes(damaged_docs(spark, sf)))


def cube_tyre_value(spark: SparkSession, sf: str) -> DataFrame:
    """Tyre value rows from the cube: cleaned labels, HS category and general category."""
    long = decode_cube(star_cubes(spark, sf), dims=CONFORM_DIMS)
    tyre_codes = dims.values_df(spark, "code", [c for _p, c in STAR_TYRE_PRODUCTS])
    cat = dims.small_table(spark, [(c, cat) for _l, c, cat in dims.TYRE_PRODUCTS], "hs_code string, category string")
    general = dict(dims.TYRE_CATEGORY_GENERAL)
    gen = dims.small_table(spark, [(c, general[k]) for _l, c, k in dims.TYRE_PRODUCTS],
                           "hs_code string, general_category string")
    return conform_cube(long, "VALUE_IN_EUROS", "value", tyre_codes, hs_dims=[cat, gen])


def cube_vehicle_weight(spark: SparkSession, sf: str) -> DataFrame:
    """Vehicle weight rows from the cube (requested codes only), general category."""
    long = decode_cube(star_cubes(spark, sf), dims=CONFORM_DIMS)
    wanted = dims.values_df(spark, "code", [c for c, _g in dims.VEHICLE_HS_GENERAL
                                            if c not in dims.VEHICLE_CUBE_EXCLUDED])
    return conform_cube(long, "QUANTITY_IN_100KG", "weight", wanted, hs_dims=[dims.vehicle_general_dim(spark)])


_CELLS_SQL = """
WITH f AS (
  SELECT c.c_nationkey AS rk, s.s_nationkey AS pk, p.p_type AS product,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS date,
         l.l_returnflag, l.l_linestatus,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l.l_quantity AS DECIMAL(18,2)) AS qty
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey),
cells AS (
  SELECT CAST(year(date) AS INTEGER) AS year, rk, pk, product, date,
         SUM(CASE WHEN l_returnflag <> 'N' THEN price END) AS v,
         COUNT(CASE WHEN l_returnflag <> 'N' THEN 1 END) AS nv,
         SUM(CASE WHEN l_linestatus = 'F' THEN qty END) AS w,
         COUNT(CASE WHEN l_linestatus = 'F' THEN 1 END) AS nw
  FROM f GROUP BY ALL),
months AS (
  SELECT year, date, dense_rank() OVER (PARTITION BY year ORDER BY date) - 1 AS t_pos,
         count(*) OVER (PARTITION BY year) AS t_size
  FROM (SELECT DISTINCT year, date FROM cells)),
pd(product, product_code, product_pos) AS (VALUES ('ECONOMY', '401110', 0), ('PROMO', '401120', 1),
   ('STANDARD', '40112090', 2), ('SMALL', '8703', 3), ('MEDIUM', '8704', 4), ('LARGE', '8709', 5)),
nat AS (SELECT count(*) AS n FROM nation),
stacked AS (
  SELECT year, rk, pk, product, date, 0 AS ind_pos, 'VALUE_IN_EUROS' AS indicator_code, CAST(v AS DOUBLE) AS value,
         CASE WHEN nv < 2 THEN 'p' ELSE '' END AS status FROM cells WHERE nv > 0
  UNION ALL
  SELECT year, rk, pk, product, date, 1, 'QUANTITY_IN_100KG', CAST(w AS DOUBLE),
         CASE WHEN nw < 2 THEN 'p' ELSE '' END FROM cells WHERE nw > 0),
decoded AS (
  SELECT s.*, pd.product_code, m.t_pos, m.t_size, rn.n_name AS rname, pn.n_name AS pname,
         ((((CAST(s.rk AS BIGINT) * nat.n + s.pk) * 6 + pd.product_pos) * 2 + s.ind_pos) * m.t_size + m.t_pos)
           AS flat_index
  FROM stacked s JOIN pd USING (product) JOIN months m USING (year, date)
  JOIN nation rn ON s.rk = rn.n_nationkey JOIN nation pn ON s.pk = pn.n_nationkey, nat)"""

SQL = {
    "cube_decode": _CELLS_SQL + """
SELECT 'star-' || CAST(year AS VARCHAR) AS dataset_code, flat_index, value, status,
       'N' || CAST(rk AS VARCHAR) AS reporter_code,
       CASE WHEN rk = 24 THEN 'N24' WHEN rk % 5 = 0 THEN rname || ' (incl. X from 1991)' ELSE rname END
         AS reporter_label,
       'N' || CAST(pk AS VARCHAR) AS partner_code, pname AS partner_label,
       product_code, product AS product_label, indicator_code, indicator_code AS indicator_label,
       strftime(date, '%Y-%m') AS time_code, strftime(date, '%Y-%m') AS time_label
FROM decoded""",
    "cube_latest_period": """
SELECT 'star-' || CAST(year AS VARCHAR) AS dataset_code, max(strftime(l_shipdate, '%Y-%m')) AS latest_period,
       CAST(year + 1 AS VARCHAR) || '-02-01T00:00:00+0000' AS updated
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_shipdate FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
GROUP BY year""",
    "cube_slice_stats": _CELLS_SQL + """
SELECT 'star-' || CAST(year AS VARCHAR) AS dataset_code, count(*) AS cell_count, count(*) AS row_count,
       count(*) AS decoded_rows, CAST(year + 1 AS VARCHAR) || '-02-01T00:00:00+0000' AS response_updated
FROM stacked GROUP BY year""",
    "cube_tyre_value": _CELLS_SQL + """,
cat(hs_code, category) AS (VALUES ('401110', 'PCR'), ('401120', 'LT&TBR'), ('40112090', 'TBR')),
gen(category, general_category) AS (VALUES ('PCR', 'PCR'), ('LT&TBR', 'LT&TBR'), ('TBR', 'TBR'))
SELECT CASE WHEN rk = 24 THEN 'N24' ELSE rname END AS country, date, product, indicator_code AS indicator,
       pname AS partner, value, product_code AS hs_code, CAST(year(date) AS INTEGER) AS year,
       CAST(month(date) AS INTEGER) AS month, cat.category, gen.general_category
FROM decoded JOIN cat ON decoded.product_code = cat.hs_code JOIN gen USING (category)
WHERE indicator_code = 'VALUE_IN_EUROS'""",
    "cube_vehicle_weight": _CELLS_SQL + """,
gen(hs_code, general_category) AS (VALUES ('8703', 'PCR'), ('8704', 'TBR'))
SELECT CASE WHEN rk = 24 THEN 'N24' ELSE rname END AS country, date, product, indicator_code AS indicator,
       pname AS partner, value AS weight, product_code AS hs_code, CAST(year(date) AS INTEGER) AS year,
       CAST(month(date) AS INTEGER) AS month, gen.general_category
FROM decoded JOIN gen ON decoded.product_code = gen.hs_code
WHERE indicator_code = 'QUANTITY_IN_100KG'""",
}

SQL["cube_roundtrip"] = _CELLS_SQL + """
SELECT indicator_code || '_' || product_code || '_' || CAST(year AS VARCHAR) AS dataset_code, value, status,
       'N' || CAST(rk AS VARCHAR) AS reporter_code, 'N' || CAST(pk AS VARCHAR) AS partner_code, product_code,
       indicator_code, strftime(date, '%Y-%m') AS time_code, rname AS reporter_label, pname AS partner_label
FROM decoded"""

SQL["cube_large_doc"] = _CELLS_SQL + """,
every_month AS (
  SELECT date, dense_rank() OVER (ORDER BY date) - 1 AS pos, count(*) OVER () AS size FROM (SELECT DISTINCT date FROM cells))
SELECT 'star' AS dataset_code, 'Star trade' AS dataset_label,
       (((CAST(rk AS BIGINT) * nat.n + pk) * 6 + product_pos) * 2 + ind_pos) * every_month.size + every_month.pos AS flat_index,
       value, status, 'N' || CAST(rk AS VARCHAR) AS reporter_code,
       CASE WHEN rk = 24 THEN 'N24' WHEN rk % 5 = 0 THEN rname || ' (incl. X from 1991)' ELSE rname END AS reporter_label,
       'N' || CAST(pk AS VARCHAR) AS partner_code, pname AS partner_label, decoded.product_code,
       decoded.product AS product_label, indicator_code, indicator_code AS indicator_label,
       strftime(date, '%Y-%m') AS time_code, strftime(date, '%Y-%m') AS time_label
FROM decoded JOIN every_month USING (date) JOIN pd USING (product), nat"""

SQL["cube_errors"] = """
SELECT 'landing/star/' || CAST(y AS VARCHAR) || '.json' AS source_path, 'not of the expected shape' AS error
FROM (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
WHERE y % 4 <> 3"""

QUERIES = {
    "cube_decode": cube_decode,
    "cube_errors": cube_errors_q,
    "cube_large_doc": cube_large_doc,
    "cube_roundtrip": cube_roundtrip,
    "cube_latest_period": cube_latest_period,
    "cube_slice_stats": cube_slice_stats,
    "cube_tyre_value": cube_tyre_value,
    "cube_vehicle_weight": cube_vehicle_weight,
}
