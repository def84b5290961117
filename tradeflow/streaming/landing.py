"""Incremental decode of a landing folder with Structured Streaming.

New response files are picked up by a file-source stream (the stream's
checkpoint remembers which files were processed, so each lands once), parsed,
decoded and added to the long table, a partition per micro-batch, so a batch
that is run again replaces its own rows. A file that cannot be decoded whole
stops the stream and is named. ``availableNow`` processes what is there and
stops, which suits scheduled runs; a processing-time trigger keeps it running.
Files rewritten in place are not seen again by a file stream; refreshed slices
go to new paths (the request plan names them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cube import decode_cube
from ..sinks.tables import write_partitions
from ..sources.cubes import parse_cubes, require_whole_cubes


def landing_stream(spark: SparkSession, landing: str, glob: str = "*.json",
                   max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming (json, source_path) of the files arriving under ``landing``."""
    return (spark.readStream.format("text").option("wholetext", "true")
            .option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", str(max_files_per_trigger))
            .load(landing)
            .select(F.col("value").alias("json"), F.col("_metadata.file_path").alias("source_path")))


def start_landing_ingest(spark: SparkSession, landing: str, out: str, checkpoint: str,
                         available_now: bool = True) -> StreamingQuery:
    """Add the decoded cells of new files to ``out`` (parquet, by batch and dataset)."""
    def add(texts: DataFrame, batch: int) -> None:
        cells = decode_cube(require_whole_cubes(parse_cubes(texts).checkpoint()))
        write_partitions(cells.withColumn("batch", F.lit(batch)), out, ["batch", "dataset_code"])

    writer = landing_stream(spark, landing).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
