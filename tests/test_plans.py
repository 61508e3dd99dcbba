"""Plan-shape guards: the physical properties the scale design relies on."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF0001, SF001

QUERIES = entry_mod.queries()


def _final_plan(spark, name, sf=SF0001):
    df = QUERIES[name](spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]  # the adaptive plan as it ran


def test_topk_is_computed_once_and_titles_are_not_broadcast(spark):
    plan = _final_plan(spark, "topk_rated_items", SF001)
    assert "TakeOrderedAndProject" in plan and "ReusedExchange" in plan
    assert "LeftSemi" in plan  # titles streamed past the broadcast winners


def test_per_group_arg_max_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in _final_plan(spark, "preferred_category")


def test_set_ops_shuffle_each_side_once(spark):
    for name, join in (("intersect_lines", "LeftSemi"), ("difference_lines", "LeftAnti")):
        plan = _final_plan(spark, name)
        assert join in plan
        assert len(re.findall(r"Exchange hashpartitioning\(value", plan)) == 2


def test_parser_never_filters_on_a_recomputed_split(spark):
    plan = _final_plan(spark, "parse_tab_ratings", SF001)
    assert "Generate inline" in plan
    filters = [ln for ln in plan.split("\n") if "Filter" in ln]
    assert filters and not any("split(" in ln for ln in filters)


@pytest.mark.parametrize("name", ["word_count", "item_rating_stats", "avg_rating_by_group"])
def test_aggregates_are_partial_before_the_shuffle(spark, name):
    plan = _final_plan(spark, name)
    assert plan.count("HashAggregate") >= 2  # partial (map side) + final


def test_scans_read_only_needed_columns(spark):
    plan = _final_plan(spark, "matvec")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in schemas
    assert "struct<p_partkey:bigint,p_size:int>" in schemas


def test_iqr_bounds_reach_the_parquet_reader(spark):
    plan = _final_plan(spark, "iqr_filter")
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert any("GreaterThanOrEqual(value" in p and "LessThanOrEqual(value" in p for p in pushed)


def test_boxplot_counts_outliers_without_shuffling_the_data(spark):
    plan = _final_plan(spark, "boxplot_stats", SF001)
    # one row of fences a group goes to the tasks; only partial counts are shuffled
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") <= 1


def test_no_scan_is_repartitioned_before_its_work(spark):
    for name in ("word_count", "accuracy", "parse_tab_ratings"):
        assert "REPARTITION" not in _final_plan(spark, name, SF001)
