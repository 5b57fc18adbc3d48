"""Physical-plan properties every registered query must keep."""
import pytest

from carelake.plans import registry

from .conftest import SF_SMALL

registry.load_all()
QUERIES = registry.QUERIES
# queries whose work is the injected judge (Arrow batches through mapInPandas)
PYTHON_ALLOWED = {"score_traces", "resumed_scoring", "validate_feedback", "feedback_summary", "guideline_rollup",
                  "live_scoring"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_nested_loop_no_row_udf(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan          # row-at-a-time Python UDFs
    if name not in PYTHON_ALLOWED:
        assert "MapInPandas" not in plan and "ArrowEvalPython" not in plan


def test_pruned_scan_and_partial_aggregate(spark):
    df = QUERIES["appeals_by_status"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(QUERIES["appeals_by_status"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan or "struct<o_orderkey:bigint>" in plan
    assert "partial_count" in plan
    assert text


def test_fk_audit_is_one_grouping_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(QUERIES["fk_audit"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


BOUNDED_WINDOW = {"result_records", "summary_pack"}   # number a bounded summary result
# 8-row brand table; per request (<= 10 rounds); per numbered chunk (<= size, asserted in test_responses)
BOUNDED_COLLECT = {"brand_drug_appeals", "tool_use_summary", "chat_answers", "history_lists"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"live_scoring"}))
def test_single_partition_only_after_reduction(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and name not in BOUNDED_WINDOW:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            # only above an aggregate (rows already reduced to groups) or a top-k
            assert "HashAggregate" in child or "TakeOrderedAndProject" in child, (name, child.strip())
        if ("collect_list" in line or "collect_set" in line) and name not in BOUNDED_COLLECT:
            raise AssertionError(f"{name}: unexpected collect: {line.strip()}")
