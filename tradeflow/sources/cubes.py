"""JSON-stat cube documents: one response file per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORY = T.StructType([
    T.StructField("index", T.MapType(T.StringType(), T.LongType())),
    T.StructField("label", T.MapType(T.StringType(), T.StringType())),
])
DIMENSION = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("category", CATEGORY),
])
CUBE_SCHEMA = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("updated", T.StringType()),
    T.StructField("id", T.ArrayType(T.StringType())),
    T.StructField("size", T.ArrayType(T.LongType())),
    T.StructField("dimension", T.MapType(T.StringType(), DIMENSION)),
    T.StructField("value", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("status", T.MapType(T.StringType(), T.StringType())),
    T.StructField("extension", T.StructType([T.StructField("datasetId", T.StringType())])),
    # The text of a document that is not of this shape.
    T.StructField("malformed", T.StringType()),
])


def scan_cubes(spark: SparkSession, path: str, glob: str = "*.json", recursive: bool = True) -> DataFrame:
    """Read response documents: one row per file plus ``source_path``.

    Each file is parsed whole in one task, so files must stay small (the
    request plan splits slices until they do). A file that is not JSON or not
    of the schema's shape has its text in ``malformed``; see :func:`cube_errors`.
    """
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return parse_cubes(reader.text(path, wholetext=True).select(F.col("value").alias("json"),
                                                F.col("_metadata.file_path").alias("source_path")))


def parse_cubes(texts: DataFrame, text_col: str = "json", path_col: str = "source_path") -> DataFrame:
    """Cube documents held as JSON text in a column -> the :data:`CUBE_SCHEMA` row."""
    parsed = F.from_json(F.col(text_col), CUBE_SCHEMA, {"columnNameOfCorruptRecord": "malformed"})
    # Generated, not projected: projections above would each parse again what
    # they need of the document.
    return texts.select(F.explode_outer(F.array(parsed)).alias("__doc"), F.col(path_col).alias("source_path")).select(
        "__doc.*", "source_path")


def cube_errors(cubes: DataFrame) -> DataFrame:
    """Documents that cannot be decoded whole: rows (source_path, error).

    ``not of the expected shape``: broken JSON, a list where positions or cells
    are an object, a cell that is no number. ``no dimensions``: nothing says
    what the cells mean. ``positions do not fit``: a dimension whose categories
    are fewer than its size.
    """
    dims, sizes = F.col("id"), F.col("size")
    short = F.exists(F.arrays_zip(dims.alias("d"), sizes.alias("n")), lambda x: F.coalesce(
        F.size(F.col("dimension")[x["d"]]["category"]["index"]) < x["n"], F.lit(True)))
    error = (F.when(F.col("malformed").isNotNull(), "not of the expected shape")
             .when(dims.isNull() | sizes.isNull() | (F.size(dims) != F.size(sizes)), "no dimensions")
             .when(short, "positions do not fit"))
    return cubes.select("source_path", error.alias("error")).where(F.col("error").isNotNull())


def require_whole_cubes(cubes: DataFrame) -> DataFrame:
    """``cubes``, or an error that names every document that cannot be decoded."""
    bad = [f"{r.source_path} ({r.error})" for r in cube_errors(cubes).orderBy("source_path").toLocalIterator()]
    if bad:
        raise ValueError(f"{len(bad)} response documents cannot be decoded: {', '.join(bad)}")
    return cubes
