"""Reading response documents that are larger than a task should hold.

A document is read as the pieces between its commas, which Spark deals to tasks
by byte ranges of the file. The pieces of its objects ``value`` and ``status``
become cells where they lie; only the rest, the header with the dimensions, is
put together and parsed as one text. The result equals parsing whole files with
:func:`~tradeflow.sources.cubes.scan_cubes` and decoding them row by row; only a
status text that holds a comma or a brace is reported as an error instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators._broadcast import bounded_broadcast
from ..operators.cube import DIMENSION_ALIASES, cube_layout, resolve_cells
from ..session import checkpoint_dir
from .cubes import cube_errors, parse_cubes

# The opening of an object of cells: its name and then a numbered place or
# nothing. Inside a JSON string the quotes would be escaped.
_OPENS = r'(?s)^(.*"{name}"\s*:\s*\{{)(\s*(?:"\d+"\s*:.*|\}}.*)?)$'
_VALUE, _STATUS = _OPENS.format(name="value"), _OPENS.format(name="status")
_NUMBER = r'(?s)^\s*"(\d+)"\s*:\s*(-?[0-9][-+0-9.eE]*|null)\s*$'
_TEXT = r'(?s)^\s*"(\d+)"\s*:\s*(".*"|null)\s*$'
BAD_SHAPE = "not of the expected shape"


class LargeCubes(NamedTuple):
    headers: DataFrame  # one parsed document per file, its cells left out
    values: DataFrame   # source_path, flat_index, value
    statuses: DataFrame  # source_path, flat_index, status
    errors: DataFrame   # source_path, error: every file that cannot be decoded whole


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_large_cubes(spark: SparkSession, path: str, glob: str = "*.json") -> LargeCubes:
    """Documents of a folder, however long each is.

    A task reads at most ``spark.sql.files.maxPartitionBytes`` of a file. The
    pieces are written to the checkpoint folder once, with the place of each in
    its file, and everything is derived from there.
    """
    order = ["block", "at"]
    lines = (spark.read.option("lineSep", ",").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .text(path))
    pieces = _stored(lines.select(
        F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text")), "cube-pieces")

    # Where each file's objects of cells begin, and what closes them: few rows,
    # as braces stand in headers only. The first brace after an opening closes it.
    text, at = F.col("text"), F.struct(*order)
    kind = F.when(text.rlike(_VALUE), "value").when(text.rlike(_STATUS), "status")
    events = pieces.where(text.contains("{") | text.contains("}")).withColumn("kind", kind)
    # A piece that opens an object may close it too; any other piece with a brace closes.
    closes = (F.when(F.col("kind") == "value", F.regexp_extract("text", _VALUE, 2))
              .when(F.col("kind") == "status", F.regexp_extract("text", _STATUS, 2)).otherwise(text).contains("}"))
    marks = events.select("source_path", *order, "kind", closes.alias("closes"))
    ahead = Window.partitionBy("source_path").orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    marks = marks.withColumn("end", F.first(F.when(F.col("closes"), at), ignorenulls=True).over(ahead))
    bounds = marks.where("kind IS NOT NULL").groupBy("source_path").agg(*[
        F.min(F.when(F.col("kind") == k, F.struct(at.alias("start"), F.col("end").alias("end")))).alias(k)
        for k in ("value", "status")])

    # One row per file that has cells: it goes to all tasks while that is small.
    placed = pieces.withColumn("place", at).join(bounded_broadcast(bounds, check=True), "source_path", "left")

    def within(k: str) -> Column:
        return F.coalesce((F.col("place") >= F.col(f"{k}.start")) & (
            F.col(f"{k}.end").isNull() | (F.col("place") <= F.col(f"{k}.end"))), F.lit(False))

    in_value, in_status = within("value"), within("status")
    section = F.when(in_value, "value").when(in_status, "status")
    starts = F.coalesce(F.col("place") == F.when(in_value, F.col("value.start")).when(in_status, F.col("status.start")),
                        F.lit(False))

    def opening(group: int) -> Column:
        return F.when(in_value, F.regexp_extract("text", _VALUE, group)).otherwise(F.regexp_extract("text", _STATUS, group))

    placed = placed.select("source_path", *order, section.alias("section"), "text", F.when(starts, opening(1)).alias("lead"),
                           F.when(starts, opening(2)).otherwise(text).alias("cells"))
    cut = F.instr("cells", "}")
    cells = placed.where("section IS NOT NULL").select(
        "source_path", "section", F.when(cut > 0, F.substring("cells", F.lit(1), cut - 1)).otherwise(F.col("cells")).alias("cell")
    ).where(F.col("cell").rlike(r"\S"))
    number = cells.where("section = 'value'").select(
        "source_path", F.regexp_extract("cell", _NUMBER, 1).try_cast("long").alias("flat_index"),
        F.regexp_extract("cell", _NUMBER, 2).alias("text"))
    values = number.where("flat_index IS NOT NULL").select(
        "source_path", "flat_index", F.col("text").try_cast("double").alias("value"))
    flag = cells.where("section = 'status'").select(
        "source_path", F.regexp_extract("cell", _TEXT, 1).try_cast("long").alias("flat_index"),
        F.from_json(F.concat(F.lit('{"s":'), F.regexp_extract("cell", _TEXT, 2), F.lit("}")), "s string")["s"].alias("status"))
    statuses = flag.where("flat_index IS NOT NULL")
    # The header keeps what stands before, between and after: all but the cells.
    rest = F.when(cut > 0, F.substring("cells", cut, F.length("cells"))).otherwise(F.lit(None))
    kept = F.when(F.col("section").isNull(), F.col("text")).otherwise(
        F.when(F.col("lead").isNotNull() | rest.isNotNull(), F.concat(F.coalesce("lead", F.lit("")), F.coalesce(rest, F.lit("")))))
    # A piece that ends an object goes on where the one that opened it stopped, without a comma.
    glued = F.col("section").isNotNull() & F.col("lead").isNull()
    headers = placed.withColumns({"kept": kept, "glued": glued}).where("kept IS NOT NULL").groupBy("source_path").agg(
        F.array_sort(F.collect_list(F.struct(*order, "kept", "glued"))).alias("parts"))
    json = F.array_join(F.transform("parts", lambda x, i: F.concat(
        F.when((i == 0) | x["glued"], F.lit("")).otherwise(F.lit(",")), x["kept"])), "")
    headers = _stored(parse_cubes(headers.select("source_path", json.alias("json"))), "cube-headers")
    broken = (number.where("flat_index IS NULL").select("source_path")
              .unionByName(flag.where("flat_index IS NULL").select("source_path")).distinct()
              .withColumn("error", F.lit(BAD_SHAPE)))
    errors = (cube_errors(headers).unionByName(broken).groupBy("source_path").agg(F.min("error").alias("error")))
    return LargeCubes(headers, values, statuses, errors)


def require_whole_large(cubes: LargeCubes) -> LargeCubes:
    """``cubes``, or an error that names every document that cannot be decoded."""
    bad = [f"{r.source_path} ({r.error})" for r in cubes.errors.orderBy("source_path").toLocalIterator()]
    if bad:
        raise ValueError(f"{len(bad)} response documents cannot be decoded: {', '.join(bad)}")
    return cubes


def decode_large(cubes: LargeCubes, dims: Sequence[str], aliases: Mapping[str, str] = DIMENSION_ALIASES) -> DataFrame:
    """The rows of ``decode_cube(..., dims=dims)``: cells meet their document's
    header where they lie, and their status by place."""
    layout = cube_layout(cubes.headers, aliases, dims)
    cells = cubes.values.join(cubes.statuses, ["source_path", "flat_index"], "left")
    found = cells.join(bounded_broadcast(layout, check=True), "source_path")
    return resolve_cells(found, dims, F.col("value"), F.col("status"))
