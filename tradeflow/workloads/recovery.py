"""Workloads on what survives failures: the journal of unmerged years and
snapshots that readers hold across a publish. They go through files in the
checkpoint folder, as the jobs do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..jobs.stages import journal_of, publish_pending
from ..operators.increment import MANIFEST_SCHEMA
from ..sinks import snapshots
from ..sinks.journal import YEAR
from ..sinks.tables import overwrite_years, write_versioned
from ..sources.stage import read_stage
from .stages import EMPTIED, RESTATED, _folder, _lines
from .star import EXACT
from .tables import table

SCHEMA = f"date date, l_returnflag string, hs_code string, value {EXACT}, year int"


class _Lost(Exception):
    """The publisher ends in the middle of a merge."""


def _per_year(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("value"))


def _restated(lines: DataFrame) -> DataFrame:
    again = lines.where(F.col("year").isin(*RESTATED))
    return again.withColumn("value", (F.col("value") * 2).cast(EXACT))


def journal_recovery(spark: SparkSession, sf: str) -> DataFrame:
    """Two stage runs commit; the publisher fails in the middle of the second
    merge; a later call finds no new source, yet publishes what was left."""
    lines, root = _lines(spark, sf), _folder(spark, "recovery")
    stage, out, manifest = f"{root}/stage", f"{root}/published", f"{root}/manifest"
    journal = journal_of(spark, manifest)

    def commit(run: str, rows: DataFrame, emptied: list[int]) -> None:
        years = rows.select("year").union(spark.createDataFrame([(y,) for y in emptied], "year int")).distinct()
        journal.append(run, "lines", "value", YEAR, years)
        overwrite_years(spark, rows, stage, emptied)
        write_versioned(spark.createDataFrame([], MANIFEST_SCHEMA), manifest, run)

    def merge(years: list[int] | None, fail: bool = False) -> list[int]:
        rows = read_stage(spark, stage, years)
        if fail:  # one year is written, the others and the emptied one are not
            overwrite_years(spark, rows.where(F.col("year") == min(years)), out)
            raise _Lost
        gone = set() if years is None else set(years) - {r.year for r in rows.select("year").distinct().collect()}
        overwrite_years(spark, rows, out, sorted(gone))
        return years or []

    commit("1", lines, [])
    publish_pending(spark, manifest, merge, everything=True)
    commit("2", _restated(lines), [EMPTIED])
    try:
        publish_pending(spark, manifest, lambda years: merge(years, fail=True))
    except _Lost:
        pass
    publish_pending(spark, manifest, merge)
    return _per_year(read_stage(spark, out))


def snapshot_publish(spark: SparkSession, sf: str) -> DataFrame:
    """A reader opens the table, two years are restated and one emptied in one
    publish, another reader opens it: what each of them sees."""
    lines, root = _lines(spark, sf), _folder(spark, "snapshot")
    snapshots.publish(spark, lines, root, sort_within=["hs_code"], numeric=["hs_code"])
    before = snapshots.open_snapshot(spark, root)
    snapshots.publish(spark, _restated(lines), root, emptied=[EMPTIED], sort_within=["hs_code"], numeric=["hs_code"])
    after = snapshots.open_snapshot(spark, root)
    snapshots.vacuum(spark, root, keep=2)
    return (_per_year(before.read(SCHEMA)).withColumn("state", F.lit("before"))
            .unionByName(_per_year(after.read(SCHEMA)).withColumn("state", F.lit("after"))))


def snapshot_years(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by year, published month after month of the year they were placed
    in; a reader of two years lists the folders of these alone."""
    orders = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.col("o_totalprice").cast(EXACT).alias("value"))
    root = _folder(spark, "half-years")
    for half in (orders.where("month <= 6"), orders):
        snapshots.publish(spark, half, root)
    return _per_year(snapshots.open_snapshot(spark, root).read(f"month int, value {EXACT}, year int", RESTATED))


_AMOUNT = "CAST(l_extendedprice AS DECIMAL(18,2))"
_RESTATED = f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n,
       CAST(sum({_AMOUNT} * CASE WHEN year(l_shipdate) IN {RESTATED} THEN 2 ELSE 1 END) AS DOUBLE) AS value
FROM lineitem WHERE year(l_shipdate) <> {EMPTIED} GROUP BY 1"""

SQL = {
    "journal_recovery": _RESTATED,
    "snapshot_publish": f"""
SELECT *, 'after' AS state FROM ({_RESTATED})
UNION ALL
SELECT CAST(year(l_shipdate) AS INTEGER), count(*), CAST(sum({_AMOUNT}) AS DOUBLE), 'before' FROM lineitem GROUP BY 1""",
    "snapshot_years": f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM orders WHERE year(o_orderdate) IN {RESTATED} GROUP BY 1""",
}

QUERIES = {"journal_recovery": journal_recovery, "snapshot_publish": snapshot_publish, "snapshot_years": snapshot_years}
