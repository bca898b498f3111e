"""Shape of the physical plans: what makes the queries hold at size."""

from __future__ import annotations

import re

import pytest

from surveyflow.operators import clean, quantiles, stats
from surveyflow.plans import queries as Q
from surveyflow.plans import stages

# Queries whose DataFrame only reads back what an eager step wrote or fitted.
EAGER = {"stage_tables", "top_features", "chart_top_features"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(Q.registered()) - EAGER))
def test_no_python_workers_and_no_cross_joins(spark, small_dir, name):
    plan = plan_of(Q.registered()[name](spark, small_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_predicates_reach_the_scan_and_columns_are_pruned(spark, spec, small_dir):
    plan = plan_of(stats.severity_distribution(Q.gold(spark, small_dir), spec))
    (schema,) = set(re.findall(r"ReadSchema: struct<(.*)>", plan))
    assert {field.split(":")[0] for field in schema.split(",")} == {spec.age, *spec.items}
    (pushed,) = set(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan))
    assert f"GreaterThanOrEqual({spec.age},18.0)" in pushed
    assert all(f"LessThanOrEqual({c},3.0)" in pushed for c in spec.items)


def test_means_are_pruned_from_the_shared_aggregate(spark, spec, small_dir):
    plan = plan_of(stats.severity_distribution(Q.gold(spark, small_dir), spec))
    assert "avg(" not in plan


def test_stages_do_not_shuffle(spark, spec, small_dir):
    raw = Q.bronze(spark, small_dir)
    for df in (stages.gold(stages.silver(raw, spec), spec), stages.eligible(raw, spec), clean.fill_unknown(raw, spec)):
        assert "Exchange" not in plan_of(df)


def test_split_adds_no_shuffle_of_the_rows(spark, spec, small_dir):
    """The rows meet the thresholds in a broadcast join; only counts and one bucket per class are exchanged."""
    plan = plan_of(Q.stratified_split(spark, small_dir))
    top = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in top and "Exchange hashpartitioning" not in top.split("Initial Plan")[0]


def test_histogram_is_combined_before_the_shuffle_and_read_from_storage(spark, spec, small_dir):
    gold = Q.gold(spark, small_dir)
    assert "partial_count(1)" in plan_of(quantiles.value_histogram(gold, spec.numeric))
    df = quantiles.column_medians(gold, spec.numeric)
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "/histogram-" in final and spec.numeric[0] not in final


def test_windows_over_rows_are_partitioned(spark, spec, small_dir):
    """A window without partitioning needs all its rows in one task; only aggregated frames may do that."""
    for name in sorted(set(Q.registered()) - EAGER):
        plan = plan_of(Q.registered()[name](spark, small_dir))
        for line_number, line in enumerate(lines := plan.splitlines()):
            if "Exchange SinglePartition" in line:
                below = "\n".join(lines[line_number + 1 : line_number + 8])
                assert "Aggregate" in below or "Window" in below, (name, below)


@pytest.mark.parametrize(("name", "scans"), [("chart_box_score", 2), ("column_medians", 1), ("stratified_split", 3)])
def test_number_of_scans(spark, small_dir, name, scans):
    """Counting, finding the last bucket and marking are three passes; quartiles and whiskers read the histogram."""
    df = Q.registered()[name](spark, small_dir)
    df.collect()
    assert plan_of(df).split("Initial Plan")[0].count("FileScan") == scans
