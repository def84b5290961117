"""Change detection against a source manifest and the years it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import years_text

MANIFEST_SCHEMA = T.StructType([
    T.StructField("module", T.StringType()),
    T.StructField("measure", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("mtime", T.TimestampType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("years", T.ArrayType(T.IntegerType())),
    T.StructField("min_date", T.DateType()),
    T.StructField("max_date", T.DateType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("active", T.BooleanType()),
    T.StructField("updated_at", T.TimestampType()),
])

MANIFEST_ORDER = ["module", "measure", "source_name", "source_path"]
STATES = ("new", "changed", "unchanged", "removed", "restored", "gone")


def profile_sources(df: DataFrame, source: Sequence[str] | str = "source_path", date: str = "date") -> DataFrame:
    """Per source: sorted distinct years (and as text), min/max date, row count.

    Partial aggregation keeps a hot source cheap: each task sends one set of
    years per source, not its rows.
    """
    keys = [source] if isinstance(source, str) else list(source)
    years = F.array_sort(F.collect_set(F.year(date).cast("int")))
    return df.groupBy(*keys).agg(
        years.alias("years"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        F.count(F.lit(1)).alias("row_count"),
    ).withColumn("years_text", years_text("years"))


def diff_sources(listing: DataFrame, manifest: DataFrame, *, cached: DataFrame | None = None,
                 full_refresh: bool = False) -> DataFrame:
    """Compare the current file listing with the manifest of one stage.

    ``state``: new (unknown path), changed (fingerprint differs), unchanged,
    removed (active in the manifest, no longer listed), restored (listed again
    after removal: its rows must come back), gone (removed earlier, still
    absent: nothing to do). ``refresh`` marks the sources to read again: full
    refresh, new, changed, restored, or a missing cache (``cached`` holds the
    source paths whose cache exists; omitted = all present).
    """
    cur = listing.select("source_path", F.col("source_name").alias("__name"), "fingerprint", "size_bytes",
                         "mtime", F.lit(True).alias("__listed"))
    prev = manifest.select("source_path", F.col("source_name").alias("__prev_name"),
                           F.col("fingerprint").alias("prev_fingerprint"),
                           F.col("years").alias("prev_years"), "active", F.col("source_id").alias("prev_source_id"),
                           F.lit(True).alias("__known"))
    d = cur.join(prev, "source_path", "full_outer")
    listed = F.coalesce(F.col("__listed"), F.lit(False))
    known = F.coalesce(F.col("__known"), F.lit(False))
    active = F.coalesce(F.col("active"), F.lit(False))
    state = (F.when(listed & ~known, F.lit("new"))
              .when(listed & ~active, F.lit("restored"))
              .when(listed & (F.col("fingerprint") != F.col("prev_fingerprint")), F.lit("changed"))
              .when(listed, F.lit("unchanged"))
              .when(active, F.lit("removed"))
              .otherwise(F.lit("gone")))
    d = d.withColumn("state", state)
    if cached is not None:
        d = d.join(cached.select("source_path", F.lit(True).alias("__cached")), "source_path", "left")
        cache_ok = F.coalesce(F.col("__cached"), F.lit(False))
    else:
        cache_ok = F.lit(True)
    refresh = F.col("state").isin("new", "changed", "restored") | ((F.col("state") == "unchanged") & ~cache_ok)
    if full_refresh:
        refresh = listed
    return d.select(
        "source_path", F.coalesce("__name", "__prev_name").alias("source_name"), "state",
        refresh.alias("refresh"), "fingerprint", "size_bytes", "mtime", "prev_fingerprint",
        F.coalesce("prev_years", F.array().cast("array<int>")).alias("prev_years"), "prev_source_id")


def affected_years(diff: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Years to rebuild: new and previous years of refreshed sources, years of removed ones.

    ``profile`` (``source_path, years``) gives the years of the refreshed
    sources as read now.
    """
    touched = diff.where(F.col("refresh") | (F.col("state") == "removed"))
    prev = touched.select(F.explode("prev_years").alias("year"))
    out = prev
    if profile is not None:
        fresh = (profile.join(diff.where(F.col("refresh")).select("source_path"), "source_path", "left_semi")
                 .select(F.explode("years").alias("year")))
        out = out.unionByName(fresh)
    return out.where(F.col("year").isNotNull()).distinct()


def next_manifest(manifest: DataFrame, diff: DataFrame, profile: DataFrame, module: str, measure: str,
                  source_id) -> DataFrame:
    """Manifest after a run: other stages untouched, current sources updated, removed ones inactive.

    ``profile``: ``source_path, years, min_date, max_date, row_count`` of the
    refreshed sources; unchanged sources keep their previous profile.
    ``source_id``: Column computing the cache id from ``source_path``.
    """
    this = (F.col("module") == F.lit(module)) & (F.col("measure") == F.lit(measure))
    others = manifest.where(~this)
    old = manifest.where(this)
    now = F.date_trunc("second", F.current_timestamp())
    cur = (diff.where(F.col("state").isin("new", "changed", "unchanged", "restored"))
           .join(profile.select("source_path", F.col("years").alias("__y"), F.col("min_date").alias("__min"),
                                F.col("max_date").alias("__max"), F.col("row_count").alias("__n")),
                 "source_path", "left")
           .join(old.select("source_path", "years", "min_date", "max_date", "row_count"), "source_path", "left"))
    fresh = F.col("refresh")
    current = cur.select(
        F.lit(module).alias("module"), F.lit(measure).alias("measure"), "source_name", "source_path",
        "fingerprint", "size_bytes", "mtime", source_id.alias("source_id"),
        F.when(fresh, F.col("__y")).otherwise(F.col("years")).alias("years"),
        F.when(fresh, F.col("__min")).otherwise(F.col("min_date")).alias("min_date"),
        F.when(fresh, F.col("__max")).otherwise(F.col("max_date")).alias("max_date"),
        # A source that was read and kept no row has count 0: it is not read again.
        F.when(fresh, F.coalesce("__n", F.lit(0))).otherwise(F.col("row_count")).alias("row_count"),
        F.lit(True).alias("active"), now.alias("updated_at"))
    removed = (old.join(diff.where(F.col("state").isin("removed", "gone")).select("source_path"), "source_path",
                        "left_semi")
               .withColumn("updated_at", F.when(F.col("active"), now).otherwise(F.col("updated_at")))
               .withColumn("active", F.lit(False)))
    cols = [f.name for f in MANIFEST_SCHEMA.fields]
    return others.select(*cols).unionByName(current.select(*cols)).unionByName(removed.select(*cols))
