"""Plan checks: no Python UDF or cartesian product anywhere, filters and
column pruning reach the Parquet scan, map-side combine before shuffles."""

import pytest

import __spark_entry__ as E
from tidemark.plans import q_core, registry

from conftest import SF001

registry.load_all()
#: Queries whose plan is that of the operator; the others land files or publish tables first
#: and would show a scan of those.
NAMES = sorted(n for n, f in registry.QUERIES.items() if f.__module__.rpartition(".")[2] in ("q_core", "q_flows"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_python_no_cartesian(spark, name):
    p = _plan(E.queries()[name](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"


def test_pushdown_and_pruning(spark):
    p = _plan(q_core.window_both_bounds(spark, SF001))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in p
    p = _plan(q_core.merge_newer_wins(spark, SF001))
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in p


def test_partial_aggregation_before_shuffle(spark):
    p = _plan(q_core.daily_last_value(spark, SF001))
    assert "partial_max_by" in p
    p = _plan(q_core.latest_header(spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def _exchanges(df):
    p = _plan(df)
    return sum(1 for line in p.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line)


@pytest.mark.parametrize("name,limit", [("latest_header", 1), ("latest_client", 1), ("daily_last_value", 1),
                                        ("merge_newer_wins", 2), ("merge_partial", 2), ("dup_keys", 1),
                                        ("hwm_by_branch", 1), ("latest_n", 1), ("header_item_counts", 2)])
def test_shuffle_count_bounded(spark, name, limit):
    assert _exchanges(E.queries()[name](spark, SF001)) <= limit
