"""Small operations on paths of the cluster file system, through Spark's own clients."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names right under a folder; none if it does not exist."""
    fs, p = _at(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch."""
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False if there is none."""
    fs, p = _at(spark, path)
    return fs.delete(p, True)


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False, and nothing written, if the name is taken."""
    fs, p = _at(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as exc:  # noqa: BLE001 - a Java exception, told by its class
        if "FileAlreadyExistsException" in str(exc) or fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
