"""Plan shapes the design relies on (guards against regressions at scale)."""

from __future__ import annotations

from tradeflow.operators import align_pair, keep_latest
from tradeflow.workloads import star

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_alignment_is_one_exchange(spark):
    v = spark.range(100).selectExpr("cast(id % 7 as string) as k", "cast(id as double) as value")
    w = spark.range(100).selectExpr("cast(id % 5 as string) as k", "cast(id as double) as weight")
    plan = _plan(align_pair(v, w, ["k"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan and "partial_sum" in plan


def test_keep_latest_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as o")
    plan = _plan(keep_latest(df, ["k"], ["o"]))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_floor_reaches_the_parquet_scan(spark):
    plan = _plan(star.star_facts(spark, SF, star.FLOOR))
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01" in plan


def test_stage_rebuild_joins_no_line_by_nested_loops(spark):
    from tradeflow.workloads.increment import stage_rebuild
    plan = _plan(stage_rebuild(spark, SF))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # by the business key


def test_a_cluster_needs_a_shared_checkpoint_folder():
    import pytest

    from tradeflow import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def _big_tab(spark, rows):
    tab = ["'a.xlsx' as source_name", "'p/a.xlsx' as source_path", "timestamp'2024-01-01' as source_mtime",
           "0 as sheet_ord", "'Sheet 1' as sheet"]
    fixed = spark.createDataFrame(
        [(4, 2, "M"), (5, 2, "P"), (6, 2, "I"), (7, 2, "V"), (9, 0, "R"), (9, 2, "China"), (9, 3, "China"), (9, 5, "Japan"),
         (10, 2, "units")], "row int, col int, text string").selectExpr(*tab, "row", "col", "text")
    body = spark.range(rows).selectExpr(*tab, "cast(11 + id as int) as row", "explode(array("
                                        "named_struct('col', 0, 'text', 'Spain'), named_struct('col', 1, 'text', '2024-01'), "
                                        "named_struct('col', 2, 'text', '1'), named_struct('col', 3, 'text', cast(id as string)), "
                                        "named_struct('col', 5, 'text', ':'))) as c").selectExpr(
        "source_name", "source_path", "source_mtime", "sheet_ord", "sheet", "row", "c.col", "c.text")
    return fixed.unionByName(body)


def test_unpivot_moves_the_cells_once(spark):
    from tradeflow.operators.matrix import matrix_to_long
    plan = _plan(matrix_to_long(_big_tab(spark, 100).checkpoint()))
    assert plan.count("Exchange ") <= 3 and plan.count("Exchange hashpartitioning") == 3
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_tab_of_a_million_rows_is_many_tasks(spark):
    from pyspark.sql import functions as F

    from tradeflow.operators.matrix import matrix_to_long
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        long = matrix_to_long(_big_tab(spark, 1_000_000).checkpoint())
        per_task = long.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count("*").alias("n"), F.sum("value").alias("s"), F.count_distinct("partner").alias("p"),
            F.count(F.when((F.col("country") == "Spain") & (F.col("date") == "2024-01"), 1)).alias("labelled")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r.n for r in per_task) == 3_000_000 and sum(r.s for r in per_task) == 1_000_000 + 999_999 * 500_000
    assert sum(r.labelled for r in per_task) == 3_000_000
    assert len(per_task) >= 3 and max(r.n for r in per_task) < 1_200_000
    assert {r.p for r in per_task} == {3}  # China, China.1, Japan


def test_keep_latest_of_a_bucketed_cache_has_no_exchange(spark):
    from tradeflow.workloads.increment import bucketed_rebuild
    plan = _plan(bucketed_rebuild(spark, SF))
    assert "Exchange" not in plan and "Bucketed: true" in plan and "Window" in plan


def test_the_strict_lookup_reads_its_rows_once(spark):
    """The result is the written table: nothing of the plan before it runs again."""
    from tradeflow.workloads.star import product_lookup_strict
    plan = _plan(product_lookup_strict(spark, SF))
    assert "lineitem" not in plan and "Join" not in plan and "mapped-" in plan


def test_a_numbered_plan_has_many_tasks_and_no_cross_join(spark, monkeypatch):
    from tradeflow.plans import numbered
    from tradeflow.workloads.plans import many_chunks, star_lists
    monkeypatch.setattr(numbered, "SLICES_A_TASK", 5)
    slices = numbered.numbered_slices(spark, star_lists(spark, SF))
    lists = star_lists(spark, SF)
    assert slices.rdd.getNumPartitions() > 10
    assert slices.distinct().count() == 2 * lists.products.count() * lists.years.count()
    for df in (slices, many_chunks(spark, SF)):
        plan = _plan(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Range (0" in plan


def test_a_cache_has_buckets_for_its_rows(spark, monkeypatch):
    from tradeflow.sinks import buckets
    from tradeflow.workloads.increment import bucketed_rebuild
    assert buckets.buckets_for(36_000_000) * buckets.BUCKET_ROWS >= 36_000_000
    assert buckets.buckets_for(0) == buckets.LEAST_BUCKETS
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 500)
    wanted = buckets.buckets_for(spark.read.parquet(f"{SF}/lineitem.parquet").count())
    assert wanted > buckets.LEAST_BUCKETS
    assert f"out of {wanted}" in _plan(bucketed_rebuild(spark, SF))


def test_the_merge_joins_its_facts_once(spark, monkeypatch):
    """The stages read their lines from the written facts."""
    from tradeflow.workloads import stages
    plans, write = [], stages.overwrite_years
    monkeypatch.setattr(stages, "overwrite_years", lambda s, rows, path: (plans.append(_plan(rows)), write(s, rows, path)))
    stages.merge_stages(spark, SF)
    assert len(plans) == 4 and not any("Join" in p or "lineitem" in p for p in plans)
