"""Plan audit: the SQL-checkable queries stay JVM-side and pair-free."""

import contextlib
import io

import pytest

import __spark_entry__ as entry

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_plan_has_no_pairs_or_python(spark, sf_small, name):
    plan = _plan(entry.queries()[name](spark, sf_small))
    for op in FORBIDDEN:
        assert op not in plan, (name, op)


def test_top_k_uses_group_limit(spark, sf_small):
    plan = _plan(entry.queries()["org_topk_rest"](spark, sf_small))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_percent_rank_has_no_global_window_over_rows(spark, sf_small):
    plan = _plan(entry.queries()["percent_rank"](spark, sf_small))
    assert "percent_rank(" not in plan
    naive = _plan(__import__("quarry.operators.splits", fromlist=["x"]).percent_rank_naive(
        entry.queries()["percent_rank"](spark, sf_small).drop("percent_rank")))
    assert "percent_rank(" in naive and "SinglePartition" in naive


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_single_partition_only_after_partial_aggregation(spark, sf_small, name):
    """A single-partition exchange may only move one row per task (a partial
    global aggregate) or the bounded per-bucket table of the prefix sum."""
    lines = _plan(entry.queries()[name](spark, sf_small)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            assert ("HashAggregate(keys=[]" in below or "HashAggregate(keys=[_b" in below
                    or "TakeOrderedAndProject" in below), (name, below)
