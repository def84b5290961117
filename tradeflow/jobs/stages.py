"""Stage and merge jobs: spreadsheets -> per-source cache -> deduped year
partitions -> aligned, published table. Incremental: only changed sources are
read, only affected years are rebuilt, the manifest is written last. A journal
(``<manifest root>_journal``) holds what runs have begun and not yet made good:
sources whose cache was being replaced, years that the published table has
still to take up. The next run finishes them, whatever step failed."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import iso_date, scale
from ..operators import (align_pair, bounded_broadcast, conform_tyre, conform_vehicle, date_floor, enrich_partner,
                         keep_latest, keep_values, measures_of, normalize_trade, ordered, tag, union_branches)
from ..operators.increment import MANIFEST_ORDER, affected_years, diff_sources, next_manifest, profile_sources
from ..operators.lookup import UnmappedValues, assert_all_mapped, write_counted
from ..operators.matrix import matrix_to_long
from ..sinks import snapshots
from ..sinks.buckets import Bucketed, bucketed_table, write_bucketed
from ..sinks.journal import SOURCE, YEAR, Entry, Journal
from ..sinks.tables import delete_partitions, export_sorted, overwrite_years, write_partitions, write_versioned
from ..sources.stage import (complete_versions, distinct_years, path_exists, read_manifest, read_stage,
                             read_years)
from ..sources.workbooks import first_available_source, list_sources, require_readable, scan_workbooks

LINEAGE = ["source_path", "source_name", "source_mtime", "partner_ord", "sheet_ord", "row"]
# Later file, then later name, then later column / tab / row wins.
LATEST_ORDER = ["source_mtime", "source_name", "partner_ord", "sheet_ord", "row"]
STAGE_ORDER = ["country", "date", "hs_code", "partner"]
PUBLISH_ORDER = ["type", "country", "date", "hs_code", "partner"]
TYRE_KEYS = ("country", "date", "product", "indicator", "partner", "hs_code", "category", "general_category")
VEHICLE_KEYS = ("country", "date", "product", "indicator", "partner", "hs_code", "general_category")
MERGED_COLUMNS = ["date", "hs_code", "product", "category", "general_category", "country", "partner", "value",
                  "weight", "type", "partner_continent", "partner_sub_region", "year"]
MERGED_SCHEMA = ", ".join(f"{c} " + {"date": "date", "value": "double", "weight": "double", "year": "int"}.get(c, "string")
                          for c in MERGED_COLUMNS)


def _tyre(spark: SparkSession, df: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
    out = conform_tyre(df, dims.tyre_product_dim(spark), dims.tyre_category_dim(spark), "", eager=None)
    return out, [("product", "hs_code"), ("product", "category"), ("category", "general_category")]


def _vehicle(spark: SparkSession, df: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
    out = conform_vehicle(df, dims.vehicle_product_dim(spark), dims.vehicle_general_dim(spark),
                          dims.VEHICLE_EXCLUDED_HS, "", eager=None)
    return out, [("product", "hs_code")]


@dataclass(frozen=True)
class StageSpec:
    """One stage: a product branch and one measure."""
    module: str
    measure: str
    keys: tuple[str, ...]
    conform: Callable[[SparkSession, DataFrame], tuple[DataFrame, list[tuple[str, str]]]]

    @property
    def schema(self) -> str:
        """DDL of the stage table (explicit, so an empty stage still reads)."""
        types = {self.measure: "double", "date": "date", "year": "int", "month": "int"}
        return ", ".join(f"`{c}` {types.get(c, 'string')}" for c in self.columns)

    @property
    def columns(self) -> list[str]:
        cat = ["category"] if "category" in self.keys else []
        return ["country", "date", "product", "indicator", "partner", self.measure, "year", "month", "hs_code",
                *cat, "general_category"]


def stage_spec(module: str, measure: str) -> StageSpec:
    measure, *more = measures_of(measure)
    if more:
        raise ValueError("a stage has one measure; build_stages takes several")
    if module == "tyre":
        return StageSpec("tyre", measure, TYRE_KEYS, _tyre)
    if module == "vehicle":
        return StageSpec("vehicle", measure, VEHICLE_KEYS, _vehicle)
    raise ValueError(f"Unknown module: {module}")


#: Columns of all business keys whose hash deals cache rows to buckets.
BUCKET_KEYS = ("country", "product", "partner")


@dataclass(frozen=True)
class StageLayout:
    """Where a stage reads and writes: source folder candidates, cache, stage table.

    With ``cache_table`` the cache is a catalog table of that name with
    ``cache_buckets`` buckets of business keys, and a rebuild chooses the latest
    rows without a shuffle by key.
    """
    sources: tuple[str, ...]
    cache: str
    stage: str
    cache_table: str | None = None
    cache_buckets: int = 64

    def bucketed(self, spec: StageSpec) -> Bucketed | None:
        if self.cache_table is None:
            return None
        types = {"source_mtime": "timestamp", "partner_ord": "int", "sheet_ord": "int", "row": "int"}
        lineage = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in [*LINEAGE, "source_id"])
        return Bucketed(self.cache_table, self.cache, f"{spec.schema}, {lineage}", ("source_id", "year"), BUCKET_KEYS,
                        self.cache_buckets)


def source_id(path_col: str = "source_path"):
    """Cache key of a source: a hash of its full path (names may collide)."""
    return F.substring(F.sha2(F.col(path_col), 256), 1, 16)


def journal_of(spark: SparkSession, manifest_root: str) -> Journal:
    """The journal that goes with a manifest."""
    return Journal(spark, f"{manifest_root.rstrip('/')}_journal")


def _uncommitted(spark: SparkSession, manifest_root: str, entries: list[Entry]) -> list[Entry]:
    """Entries of runs that never wrote their manifest version."""
    done = complete_versions(spark, manifest_root)
    return [e for e in entries if e.run not in done]


def build_stage(spark: SparkSession, spec: StageSpec, layout: StageLayout, manifest_root: str,
                full_refresh: bool = False) -> list[int]:
    """Refresh one stage; returns the affected years.

    What the run replaces is written to the journal first. Sources and years
    that an earlier run began and did not commit are done again here, also
    where the files have meanwhile gone back to what the manifest knows. The
    years stay in the journal until :func:`publish_pending` has merged them.

    1. list sources, diff against the manifest; 2. scan only sources to
    refresh, normalise, conform, replace their cache partitions; rows without
    a mapping are counted while they are written, and only if there are any is
    the written cache audited (full list of unmapped values);
    3. rebuild the affected years from every active source's cache: keep the
    latest row per business key; 4. write the manifest last.
    """
    run = time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + f"-{time.time_ns() % 10**9:09d}"
    journal = journal_of(spark, manifest_root)
    undone = _uncommitted(spark, manifest_root, journal.entries(module=spec.module, measure=spec.measure))
    buckets = layout.bucketed(spec)
    src_dir = first_available_source(spark, layout.sources)
    listing = list_sources(spark, src_dir)
    manifest = read_manifest(spark, manifest_root)
    this = manifest.where((F.col("module") == spec.module) & (F.col("measure") == spec.measure))
    if path_exists(spark, layout.cache):
        ids = spark.read.parquet(layout.cache).select("source_id").distinct()
        cached = this.join(ids, "source_id", "left_semi").select("source_path")
    else:
        cached = this.select("source_path").limit(0)
    # A source of which no row was kept has no cache to miss.
    cached = cached.unionByName(this.where("row_count = 0").select("source_path")).distinct()
    begun = journal.read(e for e in undone if e.kind == SOURCE).select(F.col("item").alias("source_path"))
    cached = cached.join(begun, "source_path", "left_anti")
    diff = diff_sources(listing, this, cached=cached, full_refresh=full_refresh).withColumn(
        "source_id", source_id()).checkpoint()

    refresh = diff.where(F.col("refresh"))
    refresh_rows = refresh.select("source_path", "source_id").collect()  # one row per changed file
    profile, mine = None, []
    if refresh_rows:
        mine.append(journal.append(run, spec.module, spec.measure, SOURCE, refresh.select("source_path")))
        # Parsed once: everything below reads the written cells.
        cells = require_readable(scan_workbooks(spark, listing.join(
            refresh.select("source_path"), "source_path", "left_semi")).checkpoint())
        delete_partitions(spark, layout.cache, "source_id", [r.source_id for r in refresh_rows])
        long = matrix_to_long(cells, spec.measure)
        normalized = normalize_trade(long.select("country", "date", "date_kind", "product", "indicator",
                                                 "partner", spec.measure, *LINEAGE),
                                     spec.measure, dims.INVALID_REPORTERS, dims.EXCLUDED_PARTNERS, keep=LINEAGE,
                                     date_kind="date_kind")
        conformed, checks = spec.conform(spark, normalized)
        conformed = conformed.withColumn("source_id", source_id())
        unmapped = write_counted(
            conformed.select(*spec.columns, *LINEAGE, "source_id"), checks,
            lambda rows: write_bucketed(rows, buckets) if buckets else write_partitions(rows, layout.cache, ["source_id", "year"]))
        written = spark.read.parquet(layout.cache).join(
            bounded_broadcast(refresh.select("source_id"), len(refresh_rows)), "source_id", "left_semi")
        try:
            if unmapped:
                assert_all_mapped(written, checks, f"{spec.module} {spec.measure}")
        except UnmappedValues:
            delete_partitions(spark, layout.cache, "source_id", [r.source_id for r in refresh_rows])
            raise
        profile = profile_sources(written, "source_path", "date")

    years = affected_years(diff, profile)
    years_list = sorted({int(r.year) for r in years.collect()} | set(journal.years(undone)))

    empty_profile = spark.createDataFrame([], "source_path string, years array<int>, min_date date, "
                                              "max_date date, row_count long")
    new_manifest = next_manifest(manifest, diff, profile if profile is not None else empty_profile,
                                 spec.module, spec.measure, source_id()).checkpoint()
    if years_list:
        journal.append(run, spec.module, spec.measure, YEAR, spark.createDataFrame([(y,) for y in years_list], "year int"))
        active = new_manifest.where((F.col("module") == spec.module) & (F.col("measure") == spec.measure)
                                    & F.col("active"))
        with_rows = {int(r.year) for r in active.select(F.explode("years").alias("year"))
                     .where(F.col("year").isin(years_list)).distinct().collect()}
        cached_rows = bucketed_table(spark, buckets) if buckets else spark.read.parquet(layout.cache)
        cache = cached_rows.where(F.col("year").isin(years_list)).join(
            bounded_broadcast(active.select("source_id"), check=True), "source_id", "left_semi")
        # Written once: the ranges of the sorted write are sampled from it.
        deduped = keep_latest(cache, list(spec.keys), LATEST_ORDER).select(*spec.columns).checkpoint()
        overwrite_years(spark, deduped, layout.stage, sorted(set(years_list) - with_rows),
                        sort_within=STAGE_ORDER, numeric=["hs_code"])
    write_versioned(ordered(new_manifest, MANIFEST_ORDER), manifest_root, run)
    journal.strike([*mine, *undone])  # the years of the undone runs are in this run's own entry
    return years_list


def build_stages(spark: SparkSession, module: str, measure: str, layouts: dict[tuple[str, str], StageLayout],
                 manifest_root: str, full_refresh: bool = False) -> list[int]:
    """Refresh one module's stages: one measure, or ``all``; the affected years."""
    years: set[int] = set()
    for m in measures_of(measure):
        years |= set(build_stage(spark, stage_spec(module, m), layouts[module, m], manifest_root, full_refresh))
    return sorted(years)


def merged_rows(tyre_value: DataFrame, tyre_weight: DataFrame, vehicle_value: DataFrame,
                vehicle_weight: DataFrame, partner_dim: DataFrame, floor: str = dims.PUBLISH_FLOOR) -> DataFrame:
    """Aligned value and weight per key for both branches, enriched and floored."""
    tyre_keys = ["country", "date", "product", "partner", "hs_code", "category", "general_category"]
    vehicle_keys = ["country", "date", "product", "partner", "hs_code", "general_category"]
    tyre = align_pair(tyre_value, tyre_weight, tyre_keys)
    tyre = tag(tyre.withColumn("weight", scale("weight", dims.WEIGHT_FACTOR)), type="Tyre")
    vehicle = align_pair(vehicle_value, vehicle_weight, vehicle_keys)
    vehicle = tag(vehicle.withColumn("weight", scale("weight", dims.WEIGHT_FACTOR)), type="Vehicle", category=None)
    both = union_branches(keep_values(tyre, "general_category", dims.FINAL_GENERAL_CATEGORIES),
                          keep_values(vehicle, "general_category", dims.FINAL_GENERAL_CATEGORIES),
                          allow_missing=True)
    out = date_floor(enrich_partner(both, partner_dim), "date", floor)
    return out.withColumn("year", F.year("date")).select(*MERGED_COLUMNS)


def build_merged(spark: SparkSession, stages: dict[tuple[str, str], str], partner_dim: DataFrame, out: str,
                 years: Iterable[int] | None = None, combined: str | None = None,
                 fallbacks: dict[tuple[str, str], DataFrame] | None = None, snapshot: bool = False) -> list[int]:
    """Re-merge the given years (when None all years of the stages and the
    fallbacks) into the published table.

    ``fallbacks`` has a combined or legacy table per stage for years that the
    stage has no partition of. A stage without a table counts as empty. With
    ``snapshot`` the published table is one of :mod:`~tradeflow.sinks.snapshots`
    (read it through :func:`read_published`), so readers never see some years
    rewritten and others not; without, years are replaced one by one.
    """
    fallbacks = fallbacks or {}
    if years is None:
        there = [spark.read.schema(stage_spec(*k).schema).parquet(p).select("date") for k, p in stages.items()
                 if path_exists(spark, p)]
        years = distinct_years(*there, *[f.select("date") for f in fallbacks.values()])
    years = sorted({int(y) for y in years})
    if not years:
        return []
    keys = [(module, m) for module in ("tyre", "vehicle") for m in measures_of("all")]
    read = {}
    for key in keys:
        schema = stage_spec(*key).schema
        read[key] = (read_years(spark, stages[key], schema, years, fallbacks.get(key)) if key in stages
                     else spark.createDataFrame([], schema))
    rows = merged_rows(*[read[k] for k in keys], partner_dim).checkpoint()
    present = set(distinct_years(rows))
    emptied = sorted(set(years) - present)
    if snapshot:
        published = snapshots.publish(spark, rows, out, emptied, sort_within=PUBLISH_ORDER,
                                      numeric=["hs_code"]).read(MERGED_SCHEMA)
    else:
        overwrite_years(spark, rows, out, emptied, sort_within=PUBLISH_ORDER, numeric=["hs_code"])
        published = read_stage(spark, out)
    if combined:
        export_sorted(published.withColumn("date", iso_date("date")), combined, PUBLISH_ORDER, numeric=["hs_code"])
    return years


def read_published(spark: SparkSession, out: str, years: Iterable[int] | None = None) -> DataFrame:
    """The published table of a ``snapshot`` merge, as it stands now."""
    return snapshots.open_snapshot(spark, out).read(MERGED_SCHEMA, years)


def publish_pending(spark: SparkSession, manifest_root: str, merge: Callable[[list[int] | None], list[int]],
                    everything: bool = False) -> list[int]:
    """Merge every year that committed stage runs have left in the journal (or
    all years) and strike those entries out once ``merge`` has returned.

    A merge that fails leaves them: the next call merges the same years, and
    those of later stage runs, again. Entries that appear while ``merge`` runs
    stay for the next call, and so do those of a stage run that has not
    committed: its stage is still to be rebuilt.
    """
    journal = journal_of(spark, manifest_root)
    open_ = journal.entries(kind=YEAR)
    waiting = {e.path for e in _uncommitted(spark, manifest_root, open_)}
    done = [e for e in open_ if e.path not in waiting]
    years = None if everything else journal.years(done)
    merged = merge(years) if years is None or years else []
    journal.strike(done)
    return merged


def build_all(spark: SparkSession, layouts: dict[tuple[str, str], StageLayout], manifest_root: str,
              partner_dim: DataFrame, out: str, full_refresh: bool = False, combined: str | None = None,
              snapshot: bool = False) -> list[int]:
    """All four stages, then the merge of every year that is affected or that an
    earlier run left unmerged."""
    for (module, measure), layout in layouts.items():
        build_stage(spark, stage_spec(module, measure), layout, manifest_root, full_refresh)
    stages = {k: v.stage for k, v in layouts.items()}
    first_run = not (snapshots.is_published(spark, out) if snapshot else path_exists(spark, out))
    return publish_pending(
        spark, manifest_root,
        lambda years: build_merged(spark, stages, partner_dim, out, years, combined, snapshot=snapshot),
        everything=full_refresh or first_run)
