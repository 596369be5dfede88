"""Plan-shape regressions: the physical plans the design relies on (static,
AQE off), checked on the registered queries over the sf0.001 tables."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.test_skew import conf


@pytest.fixture(scope="module")
def plan(spark):
    cache = {}

    def get(name):
        if name not in cache:
            with conf(spark, {"spark.sql.adaptive.enabled": "false"}):
                df = E.queries()[name](spark, SF_SMALL)
                cache[name] = df._jdf.queryExecution().executedPlan().toString()
        return cache[name]
    return get


EXCHANGE = r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)"


@pytest.mark.parametrize("name", ["json_parse", "json_flatten", "normalize_names", "clean_strings",
                                  "fill_numbers", "typed_columns", "date_parts", "union_missing",
                                  "watermark_increment", "bronze_child"])
def test_narrow_queries_do_not_shuffle(plan, name):
    assert not re.search(EXCHANGE, plan(name))


def test_latest_by_key_is_an_aggregate_not_a_window(plan):
    p = plan("latest_by_key")
    assert "max_by" in p and "Window" not in p


def test_watermark_literal_is_pushed(plan):
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThan\(ts,", plan("watermark_increment"))


def test_probe_plan_broadcasts_batch_keys(plan):
    p = plan("version_increment")
    assert "LeftSemi" in p and "BroadcastExchange" in p and "SortMergeJoin" not in p


def test_salted_join_shuffles(plan):
    p = plan("salted_join")
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p


def test_scans_read_only_needed_columns(plan):
    assert "ReadSchema: struct<o_custkey:bigint>" in plan("skew_report")
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan("distinct_rows")


@pytest.mark.parametrize("name", ["star_fact", "common_tags", "top_members", "episodes_per_season",
                                  "avg_runtime", "star_fact_hot", "common_tags_hot"])
def test_marts_never_pair_children_with_bridge(plan, name):
    p = plan(name)
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert "Window" not in p or name.startswith("top_members")
    assert not re.search(r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas)", p)


def test_global_rank_shuffles_rows_once(plan):
    """Only the sizes of the ranges move after the checkpoint."""
    p = plan("global_rank")
    assert not re.search(r"row_number\(\)", p)
    assert not re.search(r"Exchange hashpartitioning\((n_orders|o_custkey)", p)


def test_gold_child_shuffles_full_rows_once(plan):
    assert len(re.findall(r"Exchange hashpartitioning", plan("gold_child"))) == 1
