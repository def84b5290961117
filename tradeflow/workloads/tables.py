"""Access to the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# One DataFrame per (session, table path): file listing and footer reading
# happen once, later queries reuse the resolved scan.
_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _TABLES[key] = df
    return df
