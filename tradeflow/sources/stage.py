"""Readers for stage tables and manifests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.increment import MANIFEST_SCHEMA
from ..sinks.paths import names


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_stage(spark: SparkSession, path: str, years: Iterable[int] | None = None) -> DataFrame:
    """A year-partitioned stage table; ``years`` prunes partitions at the scan."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.where(F.col("year").isin([int(y) for y in years]))
    return df


def read_year_or_fallback(spark: SparkSession, path: str, year: int, fallback: DataFrame | None = None,
                          date_col: str = "date") -> DataFrame:
    """One year: its partition if present, else the fallback filtered to the year.

    The fallback (a combined or legacy table) is filtered on a date range so
    the predicate reaches the parquet scan.
    """
    if path_exists(spark, f"{path.rstrip('/')}/year={int(year)}"):
        return read_stage(spark, path, [year])
    if fallback is None:
        raise FileNotFoundError(f"No data for year {year} under {path}")
    lo, hi = f"{int(year)}-01-01", f"{int(year) + 1}-01-01"
    d = F.col(date_col).cast("date")
    return fallback.where((d >= F.lit(lo).cast("date")) & (d < F.lit(hi).cast("date")))


def complete_versions(spark: SparkSession, root: str) -> list[str]:
    """Versions that were written to their end, newest first."""
    root = root.rstrip("/")
    found = sorted((n.removeprefix("version=") for n in names(spark, root) if n.startswith("version=")), reverse=True)
    return [v for v in found if path_exists(spark, f"{root}/version={v}/_SUCCESS")]


def newest_version(spark: SparkSession, root: str) -> str | None:
    """The newest version folder that was written to its end."""
    root = root.rstrip("/")
    for name in sorted((n for n in names(spark, root) if n.startswith("version=")), reverse=True):
        if path_exists(spark, f"{root}/{name}/_SUCCESS"):
            return f"{root}/{name}"
    return None


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Newest complete manifest version; an absent manifest is an empty table.
    Older versions are not listed or read."""
    newest = newest_version(spark, root)
    if newest is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(newest)


def read_years(spark: SparkSession, path: str, schema: str, years: Iterable[int],
               fallback: DataFrame | None = None, date_col: str = "date") -> DataFrame:
    """The given years of a stage: its partitions, and for years without one the
    ``fallback`` (a combined or legacy table) if there is any. A stage that has
    no table yet has no rows."""
    years = sorted({int(y) for y in years})
    held = [y for y in years if path_exists(spark, f"{path.rstrip('/')}/year={y}")]
    if held:
        out = spark.read.schema(schema).parquet(path).where(F.col("year").isin(held))
    else:
        out = spark.createDataFrame([], schema)
    for year in [] if fallback is None else [y for y in years if y not in held]:
        rows = read_year_or_fallback(spark, path, year, fallback, date_col).withColumn("year", F.lit(year))
        out = out.unionByName(rows.select(*[F.col(c).cast(t) for c, t in out.dtypes]))
    return out


def distinct_years(*tables: DataFrame, date_col: str = "date") -> list[int]:
    """Sorted calendar years of the tables' dates, in one job over the union."""
    years = None
    for t in tables:
        own = t.select(F.year(date_col).alias("year"))
        years = own if years is None else years.unionByName(own)
    if years is None:
        return []
    return sorted(r.year for r in years.where("year IS NOT NULL").distinct().collect())
