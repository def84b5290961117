"""The jobs end to end, over files: workbooks through the stage builds to the
published table, response documents through the cube ingest.

The star tables' months are moved by 25 years, past the date from which the
jobs publish. Part types take the labels of the code lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..jobs.cubes import ingest_cubes, latest_periods
from ..jobs.stages import MERGED_COLUMNS, StageLayout, build_all, read_published
from ..operators import bounded_broadcast
from ..operators.matrix import matrix_to_long
from ..operators.cube_encode import CubeDim, document_rows, encode_cubes
from ..operators.ranking import with_global_rank
from ..plans.requests import probe_plan, read_request_config, request_plan
from ..sinks.paths import delete
from ..sources.workbooks import first_available_source, list_sources, require_readable, scan_workbooks
from .cubes import CUBE_PRODUCTS, INDICATOR_CODES, _CELLS_SQL, coded_cells
from .fixtures import landed, materialized
from .landing import write_books, write_texts
from .matrix import SQL as MATRIX_SQL
from .matrix import order_cells
from .plans import DATASET, _url, star_config
from .stages import EMPTIED, RESTATED, _folder
from .star import _MERGED_SQL, EXACT, STAR_TYRE_PRODUCTS, STAR_VEHICLE_PRODUCTS, star_facts, star_partner_dim
from .tables import table

LATER = 25
_LABELS = {code: label for label, code, _ in dims.TYRE_PRODUCTS} | {code: label for label, code in dims.VEHICLE_PRODUCTS}
#: part type, module, place of its tab, label
_TABS = [(p, module, k, _LABELS[code]) for module, products in (("tyre", STAR_TYRE_PRODUCTS), ("vehicle", STAR_VEHICLE_PRODUCTS))
         for k, (p, code) in enumerate(products)]


def workbook_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """The order tabs as real workbooks: found in the first folder that has any,
    listed, scanned and unpivoted."""
    folder = landed(spark, sf, "order_books", lambda path: write_books(
        materialized(spark, sf, "order_cells", lambda: order_cells(spark, sf)), path))
    source = first_available_source(spark, [f"{folder}/none", folder])
    cells = require_readable(scan_workbooks(spark, list_sources(spark, source)).checkpoint())
    return matrix_to_long(cells).select("source_name", "sheet", "row", "country", "date", "frequency", "product", "flow",
                                        "indicator", "partner", "partner_ord", "value")


def trade_books(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of one workbook per module, measure and year, a tab per product:
    source_name, star_year, measure, sheet_ord, sheet, row, col, text."""
    tabs = dims.small_table(spark, _TABS, "product string, module string, sheet_ord int, label string")
    sides = F.explode(F.array(
        F.struct(F.lit("value").alias("measure"), F.lit("VALUE_IN_EUROS").alias("indicator"),
                 F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice").cast(EXACT)).alias("amount")),
        F.struct(F.lit("weight").alias("measure"), F.lit("QUANTITY_IN_100KG").alias("indicator"),
                 F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast(EXACT)).alias("amount"))))
    facts = star_facts(spark, sf).join(bounded_broadcast(tabs, len(_TABS)), "product")
    keys = ["star_year", "module", "measure", "indicator", "sheet_ord", "label", "reporter_key", "country", "month", "partner_key"]
    sums = (facts.select("*", sides.alias("s")).where(F.col("s.amount").isNotNull())
            .select(F.year("date").alias("star_year"), "module", "s.measure", "s.indicator", "sheet_ord", "label",
                    "reporter_key", "country", F.month("date").alias("month"), "partner_key", "s.amount")
            .groupBy(*keys).agg(F.sum("amount").alias("amount")).checkpoint())
    row = F.lit(11) + F.col("reporter_key") * 12 + F.col("month") - 1
    tab = ["star_year", "module", "measure", "sheet_ord"]
    values = sums.select(*tab, row.alias("row"), (F.col("partner_key") + 2).alias("col"), F.col("amount").cast("string").alias("text"))
    month = F.format_string("%04d-%02d", F.col("star_year") + LATER, F.col("month"))
    labels = sums.select(*tab, "reporter_key", "country", "month").distinct().select(*tab, row.alias("row"), F.explode(F.array(
        F.struct(F.lit(0).alias("col"), F.col("country").alias("text")), F.struct(F.lit(1).alias("col"), month.alias("text")))).alias("c"))
    frame = [(4, 2, F.lit("Monthly")), (5, 2, F.col("label")), (6, 2, F.lit("IMPORT")), (7, 2, F.col("indicator")),
             (9, 0, F.lit("REPORTER/PERIOD")), (10, 0, F.lit("units"))]
    every = sums.select(*tab, "label", "indicator").distinct()
    fixed = every.select(*tab, F.explode(F.array(*[
        F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), t.alias("text")) for r, c, t in frame])).alias("c")).select(*tab, "c.*")
    heads = (sums.select(*tab, "partner_key").distinct()
             .join(table(spark, sf, "nation").select(F.col("n_nationkey").alias("partner_key"), F.col("n_name").alias("text")), "partner_key")
             .select(*tab, F.lit(9).alias("row"), (F.col("partner_key") + 2).alias("col"), "text"))
    cells = values.unionByName(labels.select(*tab, "row", "c.*")).unionByName(fixed).unionByName(heads)
    name = F.concat(F.concat_ws("_", "module", "measure"), F.lit("/trade_"), (F.col("star_year") + LATER).cast("string"), F.lit(".xlsx"))
    return cells.select(name.alias("source_name"), "star_year", "measure", "sheet_ord",
                        F.concat(F.lit("Sheet "), (F.col("sheet_ord") + 1).cast("string")).alias("sheet"),
                        F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), "text")


def stage_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """A first build of all stages and the published table; then some value books
    are restated and those of one year removed, and an incremental build takes
    up just these. What readers of the table then see."""
    cells, root = trade_books(spark, sf).checkpoint(), _folder(spark, "stage-jobs")
    wrong = (F.col("measure") == "value") & F.col("star_year").isin(*RESTATED) & (F.col("row") >= 11) & (F.col("col") >= 2)
    write_books(cells.withColumn("text", F.when(wrong, F.concat(F.lit("9"), F.col("text"))).otherwise(F.col("text"))), root)
    layouts = {(module, measure): StageLayout((f"{root}/missing", f"{root}/{module}_{measure}"),
                                              f"{root}/cache/{module}_{measure}", f"{root}/stage/{module}_{measure}")
               for module in ("tyre", "vehicle") for measure in ("value", "weight")}
    partners, out = star_partner_dim(spark, sf), f"{root}/published"
    build_all(spark, layouts, f"{root}/manifest", partners, out, snapshot=True)
    write_books(cells.where((F.col("measure") == "value") & F.col("star_year").isin(*RESTATED)), root)
    for module in ("tyre", "vehicle"):
        delete(spark, f"{root}/{module}_value/trade_{EMPTIED + LATER}.xlsx")
    build_all(spark, layouts, f"{root}/manifest", partners, out, snapshot=True)
    return read_published(spark, out).select(*MERGED_COLUMNS)


# --- the cube ingest --------------------------------------------------------------

#: LARGE has a code that is never requested from the cube source.
JOB_CODES = tuple((p, "871610" if p == "LARGE" else code) for p, code in CUBE_PRODUCTS)
UNPLANNED = 1995


def _job_config(spark: SparkSession, sf: str) -> DataFrame:
    tyre = [c for p, c in JOB_CODES if p in dict(STAR_TYRE_PRODUCTS)]
    vehicle = [c for _, c in JOB_CODES if c not in tyre]
    products = F.create_map(F.lit("tyre"), F.array(*map(F.lit, tyre)), F.lit("vehicle"), F.array(*map(F.lit, vehicle)))
    return star_config(spark, sf).withColumns(
        {"products": products, "years": F.filter("years", lambda y: y != UNPLANNED)})


def _cube_job(spark: SparkSession, sf: str) -> str:
    """A folder with the landed responses, one per indicator, product and year,
    and all that the ingest and the period probe wrote from them."""
    def write(folder: str) -> None:
        codes = dims.small_table(spark, [(dict(CUBE_PRODUCTS)[p], c) for p, c in JOB_CODES], "product_code string, code string")
        alias = F.when(F.col("indicator_code") == INDICATOR_CODES[0], "value").otherwise("weight")
        cells = (coded_cells(spark, sf).join(bounded_broadcast(codes, len(JOB_CODES)), "product_code")
                 .withColumns({"product_code": F.col("code"), "flow_code": F.lit("1")})
                 .withColumn("path", F.concat_ws("/", F.lit(DATASET), alias, "code", F.concat(F.col("year").cast("string"), F.lit(".json")))))
        sides = [CubeDim(d, f"{c}_code") for d, c in (("freq", "freq"), ("reporter", "reporter"), ("partner", "partner"),
                                                      ("product", "product"), ("flow", "flow"), ("indicators", "indicator"), ("time", "time"))]
        header = {"label": F.lit("Star trade"), "updated": F.concat(F.lit("of "), F.regexp_extract("path", r"(\d+)\.json", 1)),
                  "datasetId": F.lit(DATASET)}
        texts = document_rows(encode_cubes(cells, ["path"], sides, header), ["path"])  # small: one product and year each
        write_texts(texts.withColumnRenamed("json", "text"), f"{folder}/landing")
        _job_config(spark, sf).write.json(f"{folder}/config")
        plan = request_plan(read_request_config(spark, f"{folder}/config"))
        ingest_cubes(spark, f"{folder}/landing", f"{folder}/out", plan)
        probes = probe_plan(spark, f"https://probe.example/data/{DATASET}?x=1", "https://probe.example/statistics", [])
        latest_periods(spark, f"{folder}/landing/{DATASET}/value/401110", f"{folder}/out/latest", probes)
    return landed(spark, sf, "cube_job", write)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """A written table with each row's place in it."""
    rows = spark.read.parquet(path).select("*", "_metadata.file_name", "_metadata.row_index")
    return with_global_rank(rows, ["file_name", "row_index"], "place").drop("file_name", "row_index")


def cube_ingest_long(spark: SparkSession, sf: str) -> DataFrame:
    """The long table of the ingest in its stored order."""
    return _stored(spark, f"{_cube_job(spark, sf)}/out/long").select(
        "dataset_code", "source_updated", "indicator_code", "product_code", "time_code", "reporter_code", "partner_code",
        "flow_code", "value", "status", "place")


def cube_ingest_stages(spark: SparkSession, sf: str) -> DataFrame:
    """The four stage tables of the ingest."""
    folder, out = _cube_job(spark, sf), None
    for module in ("tyre", "vehicle"):
        for measure in ("value", "weight"):
            rows = spark.read.parquet(f"{folder}/out/{module}_{measure}").select(
                F.lit(module).alias("module"), F.lit(measure).alias("measure"), "country", "date", "partner",
                F.col(measure).alias("amount"), "hs_code", "general_category", F.col("year").cast("int").alias("year"))
            out = rows if out is None else out.unionByName(rows)
    return out


def cube_ingest_requests(spark: SparkSession, sf: str) -> DataFrame:
    """The request manifest of the ingest in its stored order; its stamp is of this run."""
    rows = _stored(spark, f"{_cube_job(spark, sf)}/out/requests")
    recent = F.col("requested_at").between(F.current_timestamp() - F.expr("INTERVAL 1 DAY"), F.current_timestamp())
    return rows.withColumn("requested_at", recent).withColumnRenamed("requested_at", "stamped")


def cube_latest_job(spark: SparkSession, sf: str) -> DataFrame:
    """The table of latest periods that the probe wrote."""
    rows = spark.read.parquet(f"{_cube_job(spark, sf)}/out/latest")
    return rows.select("dataset_code", "latest_period", "updated", "api_type", "source_url")


_LABEL_VALUES = ", ".join(f"('{p}', '{label.replace(chr(39), chr(39) * 2)}')" for p, _, _, label in _TABS)
_CODE_VALUES = ", ".join(f"('{p}', '{c}', '{'tyre' if k < len(STAR_TYRE_PRODUCTS) else 'vehicle'}')" for k, (p, c) in enumerate(JOB_CODES))
_JOB_CELLS = _CELLS_SQL + f""",
code(product, code, module) AS (VALUES {_CODE_VALUES}),
job AS (
  SELECT d.year, d.date, d.rk, d.pk, d.rname, d.pname, d.product, d.indicator_code, d.value, d.status, code.code,
         code.module, CASE WHEN indicator_code = 'VALUE_IN_EUROS' THEN 'value' ELSE 'weight' END AS alias
  FROM decoded d JOIN code USING (product))"""

SQL = {
    "workbook_sheets": MATRIX_SQL["matrix_sheets"],
    "stage_jobs": f"""
WITH label(product, label) AS (VALUES {_LABEL_VALUES}),
merged AS ({_MERGED_SQL.replace("AND m.date >= DATE '1997-01-01'", "")})
SELECT CAST(date + INTERVAL {LATER} YEAR AS DATE) AS date, hs_code, label AS product, category, general_category, country,
       partner, value, weight, type, partner_continent, partner_sub_region, CAST(year + {LATER} AS INTEGER) AS year
FROM merged JOIN label USING (product) WHERE year <> {EMPTIED}""",
    "cube_ingest_long": _JOB_CELLS + f"""
SELECT '{DATASET}' AS dataset_code, 'of ' || CAST(year AS VARCHAR) AS source_updated, indicator_code, code AS product_code,
       strftime(date, '%Y-%m') AS time_code, 'N' || CAST(rk AS VARCHAR) AS reporter_code,
       'N' || CAST(pk AS VARCHAR) AS partner_code, '1' AS flow_code, value, status,
       row_number() OVER (ORDER BY indicator_code, CAST(code AS BIGINT), code, date, 'N' || CAST(rk AS VARCHAR),
                          'N' || CAST(pk AS VARCHAR)) AS place
FROM job""",
    "cube_ingest_stages": _JOB_CELLS + """,
gen(code, general_category) AS (VALUES ('401110', 'PCR'), ('401120', 'LT&TBR'), ('40112090', 'TBR'), ('8703', 'PCR'), ('8704', 'TBR'))
SELECT module, alias AS measure, 'N' || CAST(rk AS VARCHAR) AS country, date, 'N' || CAST(pk AS VARCHAR) AS partner,
       value AS amount, code AS hs_code, general_category, CAST(year(date) AS INTEGER) AS year
FROM job JOIN gen USING (code)""",
    "cube_ingest_requests": _JOB_CELLS + f""",
yrs AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS year FROM orders),
rep AS (SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS code FROM nation),
allrep AS (SELECT string_agg('reporter=' || code, '&' ORDER BY code) AS q FROM rep),
yq AS (SELECT year, string_agg('time=' || CAST(year AS VARCHAR) || '-' || lpad(CAST(m AS VARCHAR), 2, '0'), '&' ORDER BY m) AS tq
       FROM yrs, (SELECT unnest(generate_series(1, 12)) AS m) GROUP BY year),
ind(alias, indicator_code) AS (VALUES ('value', 'VALUE_IN_EUROS'), ('weight', 'QUANTITY_IN_100KG')),
planned AS (
  SELECT alias, indicator_code, module AS product_group, code AS product_code, yrs.year, {_url('allrep.q', 'yq.tq')} AS request_url
  FROM ind, code, yrs JOIN yq USING (year), allrep WHERE yrs.year <> {UNPLANNED}),
counts AS (SELECT alias, code AS product_code, CAST(year AS BIGINT) AS year, count(*) AS n FROM job GROUP BY ALL),
every AS (
  SELECT coalesce(p.alias, c.alias) AS indicator_alias, p.indicator_code, p.product_group,
         coalesce(p.product_code, c.product_code) AS product_code, CAST(coalesce(p.year, c.year) AS VARCHAR) AS year,
         p.request_url, c.n
  FROM planned p FULL JOIN counts c ON p.alias = c.alias AND p.product_code = c.product_code AND p.year = c.year)
SELECT '{DATASET}' AS dataset_code, indicator_alias, indicator_code, product_group, product_code, year, '' AS month,
       'all' AS reporter_chunk, 'year' AS granularity, request_url,
       '{DATASET}/' || indicator_alias || '/' || product_code || '/' || year || '.json' AS cache_path,
       CASE WHEN n IS NOT NULL THEN '200' END AS status_code, n IS NOT NULL AS success,
       CASE WHEN n IS NOT NULL THEN 'of ' || year ELSE '' END AS response_updated, n AS cell_count, n AS row_count,
       true AS stamped,
       row_number() OVER (ORDER BY indicator_alias, product_group NULLS LAST, product_code, year) AS place
FROM every""",
    "cube_latest_job": _JOB_CELLS + f"""
SELECT '{DATASET}' AS dataset_code, max(strftime(date, '%Y-%m')) AS latest_period, 'of ' || CAST(year AS VARCHAR) AS updated,
       'comext' AS api_type, 'https://probe.example/data/{DATASET}?x=1' AS source_url
FROM job WHERE alias = 'value' AND code = '401110' GROUP BY year""",
}

QUERIES = {"workbook_sheets": workbook_sheets, "stage_jobs": stage_jobs, "cube_ingest_long": cube_ingest_long,
           "cube_ingest_stages": cube_ingest_stages, "cube_ingest_requests": cube_ingest_requests,
           "cube_latest_job": cube_latest_job}
