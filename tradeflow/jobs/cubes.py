"""Cube jobs: landing folder of API responses -> long table, stage inputs,
request manifest; latest available periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..operators import lookup, require_rows
from ..operators.cube import check_latest_periods, conform_cube, cube_cell_counts, decode_cube, latest_period
from ..operators.ordering import order_columns
from ..plans.requests import MANIFEST_ORDER, request_manifest
from ..sinks.tables import write_partitions
from ..sources.cubes import require_whole_cubes, scan_cubes

# Order of the long table (the time code stands for the period).
CUBE_ORDER = ["indicator_code", "product_code", "time_code", "reporter_code", "partner_code"]
STAGE_ORDER = ["country", "date", "hs_code", "partner"]


def cube_long_table(cubes: DataFrame) -> DataFrame:
    """Decoded cells with the usual dimensions projected to columns."""
    long = decode_cube(cubes)
    dims_ = ["reporter", "partner", "product", "flow", "indicator", "time", "freq"]
    cols = [F.col("codes")[d].alias(f"{d}_code") for d in dims_] + \
           [F.col("labels")[d].alias(f"{d}_label") for d in dims_]
    return long.select("dataset_code", "dataset_label", "source_updated", "source_path", "flat_index", "value",
                       "status", *cols, "codes", "labels")


def stage_inputs(spark: SparkSession, long: DataFrame) -> dict[tuple[str, str], DataFrame]:
    """The four stage tables the merge reads (tyre/vehicle x value/weight)."""
    tyre_codes = dims.values_df(spark, "code", [c for _l, c, _k in dims.TYRE_PRODUCTS])
    cat = dims.small_table(spark, [(c, k) for _l, c, k in dims.TYRE_PRODUCTS], "hs_code string, category string")
    general = dict(dims.TYRE_CATEGORY_GENERAL)
    gen = dims.small_table(spark, [(c, general[k]) for _l, c, k in dims.TYRE_PRODUCTS],
                           "hs_code string, general_category string")
    vehicle_codes = dims.values_df(spark, "code", [c for c, _g in dims.VEHICLE_HS_GENERAL
                                                   if c not in dims.VEHICLE_CUBE_EXCLUDED])
    out = {}
    for alias, code, measure in dims.INDICATORS:
        out[("tyre", measure)] = conform_cube(long, code, measure, tyre_codes, hs_dims=[cat, gen])
        out[("vehicle", measure)] = conform_cube(long, code, measure, vehicle_codes,
                                                 hs_dims=[dims.vehicle_general_dim(spark)])
    return out


def ingest_cubes(spark: SparkSession, landing: str, out: str, plan: DataFrame | None = None) -> dict[str, str]:
    """Decode every landed response, write the long table, the four stage
    tables (year-partitioned, so the merge reads them like spreadsheet stages;
    each replaces the one before, years without rows included) and, given the
    request plan, the request manifest. A response that cannot be decoded whole
    stops the job before anything is written."""
    cubes = require_whole_cubes(scan_cubes(spark, landing).checkpoint())  # parsed once
    long = cube_long_table(cubes)
    require_rows(long, "no response holds a cell; nothing was written")
    paths = {"long": f"{out}/long"}
    long.orderBy(*order_columns(CUBE_ORDER, numeric=["product_code"])).write.mode("overwrite") \
        .parquet(paths["long"])
    stored = spark.read.parquet(paths["long"])
    for (module, measure), frame in stage_inputs(spark, stored).items():
        key = f"{module}_{measure}"
        paths[key] = f"{out}/{key}"
        write_partitions(frame, paths[key], ["year"], sort_within=STAGE_ORDER, numeric=["hs_code"],
                         replace_all=True)
    if plan is not None:
        counts = cube_cell_counts(cubes).withColumn(
            "cache_path", F.regexp_extract("source_path", r"([^/]+/[^/]+/[^/]+/[^/]+)$", 1))
        paths["requests"] = f"{out}/requests"
        request_manifest(plan, counts.drop("source_path")).orderBy(*order_columns(MANIFEST_ORDER)) \
            .write.mode("overwrite").parquet(paths["requests"])
    return paths


def latest_periods(spark: SparkSession, landing: str, out: str | None = None,
                   probes: DataFrame | None = None) -> DataFrame:
    """Latest period per probed dataset response; fails on a response without time labels.

    ``probes`` (see :func:`~tradeflow.plans.requests.probe_plan`) adds
    ``api_type`` and ``source_url`` by dataset code, null for other datasets.
    """
    periods = check_latest_periods(latest_period(scan_cubes(spark, landing)))
    if probes is not None:
        periods = lookup(periods, probes, "dataset_code", ["api_type", "source_url"])
    if out:
        periods.write.mode("overwrite").parquet(out)
    return periods
