"""Failed runs lose nothing: the journal of the stage jobs, and snapshots."""

from __future__ import annotations

import os
import tempfile
import time

import pytest

from tradeflow import dims
from tradeflow.jobs import stages as jobs
from tradeflow.jobs.stages import StageLayout, build_all, build_stage, journal_of, read_published, stage_spec
from tradeflow.sinks import paths, snapshots
from tradeflow.sinks.journal import SOURCE, YEAR
from xlsx import trade_sheet, write_xlsx

TYRE = next(label for label, code, _ in dims.TYRE_PRODUCTS if code == "401110")
PARTNERS = "partner string, partner_continent string, partner_sub_region string"


def _book(folder, name, rows, mtime, code="VALUE_IN_EUROS"):
    os.makedirs(folder, exist_ok=True)
    write_xlsx(f"{folder}/{name}", [("Sheet 1", trade_sheet(TYRE, code, ["China"], rows))])
    os.utime(f"{folder}/{name}", (mtime, mtime))


@pytest.fixture()
def job(spark):
    root, now = tempfile.mkdtemp(prefix="tf-rec-"), time.time() - 1000
    layouts = {}
    for measure, code in (("value", "VALUE_IN_EUROS"), ("weight", "QUANTITY_IN_100KG")):
        folder = f"{root}/src/{measure}"
        _book(folder, "a.xlsx", [("Spain", "2023-01", [5]), ("Spain", "2024-01", [5])], now, code)
        layouts["tyre", measure] = StageLayout((folder,), f"{root}/cache/{measure}", f"{root}/{measure}")
    partners = spark.createDataFrame([("China", "Asia", "Eastern Asia")], PARTNERS)

    class Job:
        manifest, out, source = f"{root}/m", f"{root}/out", f"{root}/src/value"

        def run(self, **options):
            return build_all(spark, layouts, self.manifest, partners, self.out, **options)

        def stage(self, module="tyre", measure="value"):
            return build_stage(spark, stage_spec(module, measure), layouts[module, measure], self.manifest)

        def values(self, snapshot=False):
            rows = read_published(spark, self.out) if snapshot else spark.read.parquet(self.out)
            return {r.date.year: r.value for r in rows.collect()}

        def open(self, kind=None):
            return journal_of(spark, self.manifest).entries(kind=kind)

    Job.now, Job.layouts = now, layouts
    return Job()


@pytest.mark.parametrize("snapshot", [False, True])
def test_a_failed_merge_is_made_up_by_the_next_run(spark, job, monkeypatch, snapshot):
    assert job.run(snapshot=snapshot) == [2023, 2024]
    assert job.values(snapshot) == {2023: 5.0, 2024: 5.0} and job.open() == []
    _book(job.source, "a.xlsx", [("Spain", "2023-01", [500])], job.now + 10)  # restates 2023, empties 2024

    def fails(*a, **b):
        raise RuntimeError("executors lost")
    with monkeypatch.context() as m:
        m.setattr(jobs, "merged_rows", fails)
        with pytest.raises(RuntimeError, match="executors lost"):
            job.run(snapshot=snapshot)
    assert job.values(snapshot) == {2023: 5.0, 2024: 5.0}
    assert {e.run for e in job.open()} and journal_of(spark, job.manifest).years(job.open()) == [2023, 2024]
    assert job.run(snapshot=snapshot) == [2023, 2024]  # no source has changed since
    # The weight of 2024 has no value beside it any more.
    assert job.values(snapshot) == {2023: 500.0}
    assert job.open() == [] and job.run(snapshot=snapshot) == []


def test_a_publisher_that_dies_before_the_swap_leaves_the_table_whole(spark, job, monkeypatch):
    job.run(snapshot=True)
    _book(job.source, "a.xlsx", [("Spain", "2023-01", [7])], job.now + 10)

    def fails(*a, **b):
        raise RuntimeError("no swap")
    with monkeypatch.context() as m:
        m.setattr(snapshots, "create", fails)
        with pytest.raises(RuntimeError, match="no swap"):
            job.run(snapshot=True)
    assert job.values(True) == {2023: 5.0, 2024: 5.0}
    job.run(snapshot=True)
    assert job.values(True) == {2023: 7.0}


def test_a_stage_run_that_dies_is_done_again_though_the_file_is_as_before(spark, job, monkeypatch):
    job.run()
    original = open(f"{job.source}/a.xlsx", "rb").read()
    _book(job.source, "a.xlsx", [("Spain", "2022-01", [9])], job.now + 10)

    def fails(*a, **b):
        raise RuntimeError("no manifest")
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_versioned", fails)
        with pytest.raises(RuntimeError, match="no manifest"):
            job.stage()
    assert {e.kind for e in job.open()} == {SOURCE, YEAR}
    # The file goes back to what the manifest knows: its cache and the stage hold the other one.
    with open(f"{job.source}/a.xlsx", "wb") as fh:
        fh.write(original)
    os.utime(f"{job.source}/a.xlsx", (job.now, job.now))
    # Years of an uncommitted stage run are not the publisher's yet, nor struck out by it.
    assert jobs.publish_pending(spark, job.manifest, lambda years: pytest.fail("nothing is committed")) == []
    assert {e.kind for e in job.open()} == {SOURCE, YEAR}
    assert job.run() == [2022, 2023, 2024]
    assert job.values() == {2023: 5.0, 2024: 5.0} and job.open() == []
    stage = spark.read.parquet(job.layouts["tyre", "value"].stage)
    assert sorted(r.year for r in stage.select("year").distinct().collect()) == [2023, 2024]


def test_entries_that_appear_during_a_merge_stay(spark, job):
    job.stage()
    late = []

    def merge(years):
        assert years == [2023, 2024]
        late.append(job.stage(measure="weight"))
        return years
    jobs.publish_pending(spark, job.manifest, merge)
    assert late == [[2023, 2024]]
    assert [(e.module, e.measure, e.kind) for e in job.open()] == [("tyre", "weight", YEAR)]


def test_a_half_written_journal_entry_does_not_count(spark):
    root = tempfile.mkdtemp(prefix="tf-jnl-")
    journal = jobs.Journal(spark, root)
    kept = journal.append("1", "m", "v", YEAR, spark.createDataFrame([(2020,)], "year int"))
    half = journal.append("2", "m", "v", YEAR, spark.createDataFrame([(2021,)], "year int"))
    paths.delete(spark, f"{half.path}/_SUCCESS")
    assert journal.years(journal.entries()) == [2020] and journal.entries() == [kept]
    journal.strike([kept, half])
    assert journal.entries() == [] and journal.read([]).collect() == []


# --- snapshots ----------------------------------------------------------------

SCHEMA = "k int, year int"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _seen(snapshot, values=None):
    return sorted((r.year, r.k) for r in snapshot.read(SCHEMA, values).collect())


def test_a_handle_keeps_its_state_until_vacuum(spark):
    root = tempfile.mkdtemp(prefix="tf-snap-")
    empty = snapshots.open_snapshot(spark, root)
    assert empty.number == 0 and _seen(empty) == [] and not snapshots.is_published(spark, root)
    first = snapshots.publish(spark, _rows(spark, [(1, 2020), (2, 2021), (3, 2022)]), root)
    second = snapshots.publish(spark, _rows(spark, [(9, 2021)]), root, emptied=[2022])
    assert _seen(first) == [(2020, 1), (2021, 2), (2022, 3)]
    assert _seen(second) == _seen(snapshots.open_snapshot(spark, root)) == [(2020, 1), (2021, 9)]
    assert _seen(second, [2021]) == [(2021, 9)] and _seen(second, []) == []
    assert second.partitions() == ["year=2020", "year=2021"]
    assert snapshots.vacuum(spark, root, keep=1) == []  # all too young
    removed = snapshots.vacuum(spark, root, keep=1, age_seconds=-1)
    assert [r.split("/")[1] for r in removed] == ["year=2021", "year=2022"]
    assert _seen(snapshots.open_snapshot(spark, root)) == [(2020, 1), (2021, 9)]
    third = snapshots.publish(spark, _rows(spark, [(5, 2030)]), root, whole=True)
    assert third.number == 3 and _seen(third) == [(2030, 5)]
    nothing = snapshots.publish(spark, _rows(spark, []), root, emptied=[2030])
    assert _seen(nothing) == [] and snapshots.is_published(spark, root)


def test_an_unfinished_pointer_file_is_passed_over(spark):
    root = tempfile.mkdtemp(prefix="tf-snap-")
    snapshots.publish(spark, _rows(spark, [(1, 2020)]), root)
    assert paths.create(spark, f"{root}/pointers/{2:012d}", "year=2020\tv=gone")
    assert snapshots.open_snapshot(spark, root).number == 1
    assert snapshots.publish(spark, _rows(spark, [(2, 2021)]), root).number == 3
    assert _seen(snapshots.open_snapshot(spark, root)) == [(2020, 1), (2021, 2)]


def test_publishers_that_meet_both_succeed(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tf-snap-")
    snapshots.publish(spark, _rows(spark, [(1, 2020)]), root)
    create, met = snapshots.create, []

    def other_first(spark_, path, text):
        if not met:
            met.append(path)
            snapshots.publish(spark, _rows(spark, [(7, 2025)]), root)
        return create(spark_, path, text)
    monkeypatch.setattr(snapshots, "create", other_first)
    last = snapshots.publish(spark, _rows(spark, [(2, 2021)]), root)
    assert last.number == 3
    assert _seen(snapshots.open_snapshot(spark, root)) == [(2020, 1), (2021, 2), (2025, 7)]


def test_files_are_created_once(spark):
    path = f"{tempfile.mkdtemp(prefix='tf-path-')}/x/one"
    assert paths.create(spark, path, "ü\n") and not paths.create(spark, path, "other")
    assert paths.read_text(spark, path) == "ü\n" and paths.exists(spark, path)
    assert paths.names(spark, os.path.dirname(path)) == ["one"] or "one" in paths.names(spark, os.path.dirname(path))
    assert paths.names(spark, path + "/nowhere") == []
    assert paths.delete(spark, path) and not paths.delete(spark, path)
