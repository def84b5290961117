"""Writers for year-partitioned tables, caches and manifests."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import order_columns


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str], sort_within: Sequence[str] = (),
                     numeric: Sequence[str] = (), replace_all: bool = False) -> None:
    """Replace the partitions present in ``df`` (dynamic overwrite), or the whole
    table with ``replace_all``.

    Rows are clustered by the partition columns so each task writes few files,
    yet a large partition is written by several tasks: with ``sort_within`` as
    ranges of (partition, sort keys), so the files of a partition are in order
    one after the other; without, by a rebalance that splits what is large.
    """
    columns = [F.col(c) for c in partition_by]
    if sort_within:
        order = [*columns, *order_columns(sort_within, numeric)]
        out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    else:
        out = df.hint("rebalance", *partition_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*partition_by).parquet(path))


def delete_partitions(spark: SparkSession, path: str, column: str, values: Iterable) -> list[str]:
    """Drop ``column=value`` partition folders (years that lost all rows).

    Dynamic overwrite cannot remove a partition that receives no rows; this
    goes through the cluster file system (HDFS, object stores) of the path.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    removed = []
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(root, f"{column}={v}")
        if fs.exists(p):
            fs.delete(p, True)
            removed.append(str(v))
    return removed


def overwrite_years(spark: SparkSession, df: DataFrame, path: str, empty_years: Iterable[int] = (),
                    sort_within: Sequence[str] = (), numeric: Sequence[str] = ()) -> None:
    """Rewrite the year partitions present in ``df``; delete ``empty_years``."""
    write_partitions(df, path, ["year"], sort_within, numeric)
    delete_partitions(spark, path, "year", empty_years)


def export_sorted(df: DataFrame, path: str, keys: Sequence[str], numeric: Sequence[str] = (),
                  single_file: bool = False, fmt: str = "parquet") -> None:
    """Combined output in global order (range-partitioned sort).

    ``single_file`` funnels the sorted rows through one task: only for small
    published tables (e.g. a CSV handed to spreadsheet users).
    """
    out = df.orderBy(*order_columns(keys, numeric))
    if single_file:
        out = out.coalesce(1)
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def write_versioned(df: DataFrame, root: str, version: str) -> str:
    """Write a new version folder; readers take the newest complete one (the
    writer's ``_SUCCESS`` mark is the last file of a version).

    The table being read is never overwritten in place.
    """
    target = f"{root.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(target)
    return target
