"""Tables bucketed by a business key: rows of one key lie in one bucket of each
partition, so operators keyed by it (keep-latest) need no shuffle when reading.

A bucketed table needs a catalog entry; the files stay at the given path. The
entry can be made anew at any time from the path (:func:`bucketed_table`), so a
session with an in-memory catalog works as well as one with a metastore.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import make_folder

#: Rows of one source that a bucket holds, over all partitions, and the fewest
#: buckets of a table. A task writes or reads one bucket, so this bounds what it
#: sorts, however many rows the table has.
BUCKET_ROWS, LEAST_BUCKETS = 500_000, 8


def buckets_for(rows: int) -> int:
    """How many buckets a cache needs whose sources have up to ``rows`` rows each."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


@dataclass(frozen=True)
class Bucketed:
    """A bucketed table: catalog name, path, columns (DDL), partition columns,
    the key columns of the buckets and how many there are."""
    name: str
    path: str
    schema: str
    partition_by: tuple[str, ...]
    keys: tuple[str, ...]
    buckets: int


def bucketed_table(spark: SparkSession, table: Bucketed) -> DataFrame:
    """The table as it stands on its path."""
    parts, keys = ", ".join(f"`{c}`" for c in table.partition_by), ", ".join(f"`{c}`" for c in table.keys)
    where = table.path.replace("'", "\\'")
    make_folder(spark, table.path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table.name} ({table.schema}) USING parquet PARTITIONED BY ({parts}) "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {table.buckets} BUCKETS LOCATION '{where}'")
    spark.sql(f"MSCK REPAIR TABLE {table.name} SYNC PARTITIONS")
    return spark.table(table.name)


def write_bucketed(df: DataFrame, table: Bucketed) -> None:
    """Replace the partitions that ``df`` holds. The only shuffle of a row: each
    task writes one bucket, sorted by the key, of every partition."""
    spark = df.sparkSession
    columns = bucketed_table(spark, table).columns
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        dealt = df.repartition(table.buckets, *[F.col(c) for c in table.keys])
        dealt.select(*columns).write.insertInto(table.name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
