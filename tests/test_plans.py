"""Physical-plan properties that matter at scale (checked on the executed plan text)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

QUERIES = entry.queries()
# builders without side effects (the flows write files and run streams)
PURE = [k for k, fn in QUERIES.items()
        if not fn.__name__.startswith(("csv_", "json_", "stream", "incremental", "scan_", "materialized",
                                       "table_", "layer", "list_", "scd2_incremental", "scd_late", "cursor_",
                                       "suppliers_", "franchises_", "pipeline_", "quarantine_stream", "sql_"))]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(PURE))
def test_no_cartesian_or_nested_loop_join(spark, key):
    plan = plan_of(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scd2_shuffles_and_sorts_events_once(spark):
    """Events go by (key, slice), once (the plan shows it in both branches, which share it when run); by key alone only the summaries go."""
    lines = [x for x in plan_of(QUERIES["scd2_track_history"](spark, SF_SMALL)).splitlines() if "Exchange hashpartitioning" in x]
    by_key = [x for x in lines if "__slice" not in x]
    assert len(by_key) == 1 and 2 <= len(lines) - len(by_key) <= 3, lines  # the third only where the summaries are not broadcast


def test_fact_scan_is_pruned_and_filtered(spark):
    plan = plan_of(QUERIES["fact_sales"](spark, SF_SMALL))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line][0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
           "l_quantity:double>" in scan
    assert "PushedFilters: [IsNotNull(l_orderkey)" in scan


def test_fact_aggregate_is_partial_then_final(spark):
    plan = plan_of(QUERIES["fact_sales"](spark, SF_SMALL))
    assert "partial_sum" in plan and "partial_count" in plan


def test_latest_update_is_top_k_and_broadcast_of_one_row(spark):
    plan = plan_of(QUERIES["event_log_quality"](spark, SF_SMALL))
    assert "TakeOrderedAndProject(limit=1" in plan and "BroadcastHashJoin" in plan
