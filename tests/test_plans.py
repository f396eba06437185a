"""Physical-plan properties that matter at scale."""

import re

from indicata.plans.registry import QUERIES as Q
from tests.conftest import SF_SMALL


def plan_of(spark, key):
    """The final (AQE) plan of the query's own execution."""
    df = Q[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    text = plan.toString()
    assert "isFinalPlan=true" in text or "AdaptiveSparkPlan" not in text
    return text.split("== Initial Plan ==")[0]  # the text also lists the initial plan


def test_lookback_range_reaches_parquet(spark):
    plan = plan_of(spark, "ingest_lookback_window")
    # the plan text abbreviates long metadata, so check the first bound only
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)


def test_top_k_per_group_limits_before_shuffle(spark):
    for key in ("dedup_latest", "latest_metric_change", "last_n_months"):
        plan = plan_of(spark, key)
        assert "WindowGroupLimit" in plan and "Partial" in plan, key


def test_gold_month_sides_are_broadcast_and_no_cartesian(spark):
    plan = plan_of(spark, "gold_wide_monthly")
    assert plan.count("BroadcastHashJoin") == 3
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert bad not in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(spark, "silver_rate")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(s.count(":") <= 3 for s in schemas)


def test_series_windows_share_one_shuffle(spark):
    plan = plan_of(spark, "silver_inflation")
    by_series = re.findall(r"hashpartitioning\(serie#\d+L?, \d+\)", plan)
    assert len(by_series) == 1


def test_chunked_window_has_no_global_window(spark):
    plan = plan_of(spark, "chunked_window_single_series")
    windows = [line for line in plan.split("\n") if "Window [" in line]
    # the only unpartitioned window is the prefix sum over per-partition counts
    assert any("_chunk" in w for w in windows)


def test_table_lookup_pushes_the_month(spark):
    plan = plan_of(spark, "gold_table_lookup")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(mes_ref", plan)


def test_gold_reads_each_table_once(spark):
    """Line items go into the written supplier days, orders into one month frame."""
    plan = plan_of(spark, "gold_wide_monthly")
    assert plan.count("o_totalprice:double") == 1 and "l_quantity" not in plan
